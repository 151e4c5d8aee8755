"""SQL of the multi-step operators, as chains of common table expressions."""

from __future__ import annotations

from collections.abc import Sequence

from tabloop.catalog.fixtures import CATEGORICAL, FEATURES, h


def position(key: str, partition: str = "") -> str:
    """Place of a row in the seeded order."""
    return f"row_number() over ({partition} order by {key}, row_id)"


def index_sql(name: str, source: str, cols: Sequence[str] = CATEGORICAL) -> str:
    parts = [
        f"""select '{c}' as col, cast(row_number() over (order by {c}) - 1 as integer) as code, cast({c} as varchar) as category
    from (select distinct {c} from {source} where {c} is not null)"""
        for c in cols
    ]
    return f"{name} as (\n  " + "\n  union all\n  ".join(parts) + ")"


def coded_sql(name: str, source: str, index: str, keep: str, cols: Sequence[str] = CATEGORICAL) -> str:
    """Source with codes; `keep` lists the other columns."""
    codes = ", ".join(
        f"coalesce((select code from {index} i where i.col = '{c}' and i.category = cast(s.{c} as varchar)), -1) as {c}"
        for c in cols
    )
    return f"{name} as (select {keep}, {codes} from {source} s)"


def split_sql(name: str, source: str, share: float = 0.1, seed: int = 1242) -> str:
    return f"""{name} as (
  select * exclude (_pos), case when _pos <= ceil({share}::double * (select count(*) from {source})) then 'test' else 'train' end as split
  from (select *, {position(h(f"row_id||':{seed}'"))} as _pos from {source}))"""


def robust_sql(name: str, source: str, cols: Sequence[str]) -> str:
    """One row with low_, mid_ and high_ quartiles of the columns."""
    parts = [
        f"quantile_cont(cast({c} as double), {q}) as {prefix}_{c}"
        for c in cols
        for prefix, q in (("low", 0.25), ("mid", 0.5), ("high", 0.75))
    ]
    return f"{name} as (select {', '.join(parts)} from {source})"


def scaled(col: str, stats: str, centering: bool = False) -> str:
    """Expression over a source joined with the one-row `stats`."""
    spread = f"{stats}.high_{col} - {stats}.low_{col}"
    shift = f" - {stats}.mid_{col}" if centering else ""
    return f"(cast({col} as double){shift}) / (case when {spread} = 0 then 1 else {spread} end)"


def scaled_sql(name: str, source: str, stats: str, keep: str, cols: Sequence[str] = FEATURES) -> str:
    body = ", ".join(f"{scaled(c, stats)} as {c}" for c in cols)
    return f"{name} as (select {keep}, {body} from {source}, {stats})"


def distance(cols: Sequence[str], a: str = "a", b: str = "b") -> str:
    return " + ".join(f"({a}.{c} - {b}.{c}) * ({a}.{c} - {b}.{c})" for c in cols)


def synthesise_sql(
    name: str, source: str, label: str, cols: Sequence[str], group: str, wanted: str, k: int, seed: int
) -> list[str]:
    """`source` with synthetic rows; `wanted` names a (g, n, w) table of groups, sizes and new rows."""
    numbers = ", ".join(f"cast({c} as double) as {c}" for c in cols)
    between = ", ".join(f"a.{c} + a._u * (b.{c} - a.{c}) as {c}" for c in cols)
    return [
        f"""{name}_in as (select row_id, {group} as _g, {label}, {numbers} from {source})""",
        f"""{name}_src as (
  select s.*, w.w // w.n + case when {position(h(f"row_id||':{seed}'"), "partition by _g")} <= w.w % w.n then 1 else 0 end as copies
  from {name}_in s join {wanted} w on s._g = w.g)""",
        f"""{name}_near as (
  select a.row_id, min({{'d': {distance(cols)}, 'i': b.row_id}}, {k}) as near
  from {name}_src a join {name}_src b on a._g = b._g and a.row_id <> b.row_id where a.copies > 0 group by 1)""",
        f"""{name}_new as (
  select s.*, c.copy, {h(f"s.row_id||':'||c.copy||':u:{seed}'")} / 4294967296 as _u,
    n.near[1 + {h(f"s.row_id||':'||c.copy||':nn:{seed}'")} % {k}].i as _nn
  from {name}_src s join {name}_near n on s.row_id = n.row_id, unnest(range(1, s.copies + 1)) as c(copy))""",
        f"""{name} as (
  select row_id, {numbers}, {label}, 0 as copy, false as is_synthetic from {source}
  union all
  select a.row_id, {between}, a.{label}, cast(a.copy as integer) as copy, true as is_synthetic
  from {name}_new a join {name}_in b on a._nn = b.row_id)""",
    ]


def smote_sql(
    name: str, source: str, label: str, cols: Sequence[str], k: int = 5, strategy: str = "auto", seed: int = 1242
) -> list[str]:
    only = f" where g = (select g from {name}_size order by n, g limit 1)" if strategy == "minority" else ""
    return [
        f"{name}_size as (select {label} as g, count(*) as n from {source} group by 1)",
        f"{name}_want as (select g, n, (select max(n) from {name}_size) - n as w from {name}_size{only})",
        *synthesise_sql(name, source, label, cols, label, f"{name}_want", k, seed),
    ]


def rounded_columns(cols: Sequence[str], places: int = 6) -> str:
    return ", ".join(f"round({c}, {places}) as {c}" for c in cols)

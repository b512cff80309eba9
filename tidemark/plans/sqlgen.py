"""Small SQL text builders for the oracle statements (DuckDB dialect subset).

They only assemble ANSI SQL strings from column lists so that the oracle for a
merge or a newest-per-key query is written once per shape, not per query.
"""

from __future__ import annotations

from collections.abc import Sequence


def order_sql(version: str | None, seq: Sequence[str] = (), desc_seq: bool = False) -> str:
    parts = [f"{version} DESC NULLS LAST"] if version else []
    parts += [f"{s} {'DESC NULLS LAST' if desc_seq else 'ASC NULLS FIRST'}" for s in seq]
    return ", ".join(parts)


def latest_sql(src: str, keys: Sequence[str], order: str, cols: Sequence[str]) -> str:
    return (f"SELECT {', '.join(cols)} FROM (SELECT *, row_number() OVER (PARTITION BY "
            f"{', '.join(keys)} ORDER BY {order}) AS rn__ FROM {src}) x WHERE rn__ = 1")


def merge_sql(t: str, s: str, keys: Sequence[str], cols: Sequence[str], guard: str,
              version: str | None = None, insert_only: Sequence[str] = (),
              created: str | None = None, updated: str | None = None, run_ts: str = "NULL") -> str:
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    t_ex = "t.t__ IS NOT NULL"
    s_ex = "s.s__ IS NOT NULL"
    if guard == "newer":
        upd = (f"({s_ex} AND (t.t__ IS NULL OR t.{version} IS NULL OR "
               f"COALESCE(s.{version} > t.{version}, FALSE)))")
    elif guard == "always":
        upd = s_ex
    else:
        upd = f"({s_ex} AND t.t__ IS NULL)"
    sel = []
    for c in cols:
        if c in keys:
            sel.append(f"COALESCE(t.{c}, s.{c}) AS {c}")
        elif c == created:
            sel.append(f"CASE WHEN {t_ex} THEN t.{c} ELSE {run_ts} END AS {c}")
        elif c == updated:
            sel.append(f"CASE WHEN {upd} THEN {run_ts} ELSE t.{c} END AS {c}")
        elif c in insert_only:
            sel.append(f"CASE WHEN {t_ex} THEN t.{c} ELSE s.{c} END AS {c}")
        else:
            sel.append(f"CASE WHEN {upd} THEN s.{c} ELSE t.{c} END AS {c}")
    return (f"SELECT {', '.join(sel)} FROM (SELECT *, TRUE AS t__ FROM {t}) t "
            f"FULL OUTER JOIN (SELECT *, TRUE AS s__ FROM {s}) s ON {on}")


def date_lit(d) -> str:
    return f"DATE '{d.isoformat()}'"

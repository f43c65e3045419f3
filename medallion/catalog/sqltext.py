"""SQL counterparts of the merges, put together from their definition branch by branch."""

from __future__ import annotations

from collections.abc import Sequence


def ctes(*parts: tuple[str, str], final: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS (\n{body}\n)" for name, body in parts) + "\n" + final


def listed(columns: Sequence[str], alias: str = "") -> str:
    return ", ".join(f"{alias}.{c}" if alias else c for c in columns)


def on_keys(keys: Sequence[str], left: str = "t", right: str = "s") -> str:
    return " AND ".join(f"{left}.{k} = {right}.{k}" for k in keys)


def any_distinct(columns: Sequence[str], left: str = "t", right: str = "s") -> str:
    return "(" + " OR ".join(f"{left}.{c} IS DISTINCT FROM {right}.{c}" for c in columns) + ")"


def newest(rows: str, keys: Sequence[str], columns: Sequence[str], order: str) -> str:
    return (
        f"SELECT {listed(columns)} FROM (SELECT *, row_number() OVER (PARTITION BY {listed(keys)} "
        f"ORDER BY {order}) AS rn FROM {rows}) WHERE rn = 1"
    )


def current_step(
    target: str, source: str, keys: Sequence[str], columns: Sequence[str], update: Sequence[str],
    condition: str, stamp: tuple[str, str] | None = None, action: bool = False,
) -> str:
    """Target after an upsert: left alone, matched and kept, matched and updated, inserted."""
    stamp_name, at = stamp or ("", "")

    def tail(old: bool, name: str) -> str:
        value = f", t.{stamp_name}" if old else f", TIMESTAMP '{at}' AS {stamp_name}"
        return (value if stamp else "") + (f", '{name}' AS _action" if action else "")

    merged = ", ".join(f"s.{c}" if c in update else f"t.{c}" for c in columns)
    match = on_keys(keys)
    return f"""
SELECT {listed(columns, 't')}{tail(True, 'keep')} FROM {target} t
 WHERE NOT EXISTS (SELECT 1 FROM {source} s WHERE {match})
UNION ALL
SELECT {listed(columns, 't')}{tail(True, 'keep')} FROM {target} t JOIN {source} s ON {match}
 WHERE NOT coalesce({condition}, false)
UNION ALL
SELECT {merged}{tail(False, 'update')} FROM {target} t JOIN {source} s ON {match}
 WHERE coalesce({condition}, false)
UNION ALL
SELECT {listed(columns, 's')}{tail(False, 'insert')} FROM {source} s
 WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE {match})"""


def opened(source: str, columns: Sequence[str], at: str) -> str:
    return (
        f"SELECT {listed(columns, 's')}, TIMESTAMP '{at}' AS start_timestamp, "
        f"CAST(NULL AS TIMESTAMP) AS end_timestamp, true AS is_current, "
        f"TIMESTAMP '{at}' AS _dlt_updated_at FROM {source} s"
    )


def history_step(
    target: str, source: str, keys: Sequence[str], columns: Sequence[str],
    compare: Sequence[str], at: str, stamp_closed: bool = True,
) -> str:
    """History after a batch: untouched rows, expired ones, new versions, brand-new keys."""
    changed = any_distinct(compare)
    match = on_keys(keys) + " AND t.is_current"
    stamp = f"TIMESTAMP '{at}'" if stamp_closed else "t._dlt_updated_at"
    return f"""
SELECT t.* FROM {target} t
 WHERE NOT t.is_current OR NOT EXISTS (SELECT 1 FROM {source} s WHERE {match} AND {changed})
UNION ALL
SELECT {listed(columns, 't')}, t.start_timestamp, TIMESTAMP '{at}', false, {stamp}
  FROM {source} s JOIN {target} t ON {match} WHERE {changed}
UNION ALL
{opened(source, columns, at)} JOIN {target} t ON {match} WHERE {changed}
UNION ALL
{opened(source, columns, at)} LEFT JOIN {target} t ON {match} WHERE t.is_current IS NULL"""

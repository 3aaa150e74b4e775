"""The constraint report of a feed's tables as SQL, from the same descriptions of the tables."""

from __future__ import annotations

from collections.abc import Mapping

from sensorloom.operators.quality import ID_PATTERN
from sensorloom.sources.tables import Table


def stored_once(table: Table, sql: str) -> str:
    """Rows of a table as loads leave them: each key once, whole rows once where there is no key."""
    keys = ", ".join(f'"{column}"' for column in table.primary_key or table.one_for)
    return f"SELECT DISTINCT {f'ON ({keys})' if keys else ''} * FROM ({sql})"


def constraints_sql(rows_sql: str, tables: Mapping[str, Table], table_sql: Mapping[str, str]) -> str:
    """(table_name, check_name, violations), every count computed from the rows."""
    views = ", ".join(f"{name}_stored AS ({stored_once(tables[name], sql)})" for name, sql in table_sql.items())
    parts: list[str] = []

    def add(name: str, check: str, count: str) -> None:
        parts.append(f"SELECT '{name}' AS table_name, '{check}' AS check_name, ({count}) AS violations")

    def where(name: str, condition: str) -> str:
        return f"SELECT count(*) FILTER ({condition}) FROM {name}_stored"

    for name in table_sql:
        table = tables[name]
        if table.required:
            add(name, "not null", where(name, " OR ".join(f'"{column}" IS NULL' for column in table.required)))
        if table.max_length:
            add(name, "length", where(name, " OR ".join(
                f'coalesce(length("{column}") > {size}, false)' for column, size in table.max_length.items())))
        if table.generated_id:
            add(name, "id format", where(
                name, f"""coalesce(NOT regexp_matches("{table.generated_id}", '{ID_PATTERN}'), false)"""))
        if table.one_parent_of:
            add(name, "one parent", where(name, " + ".join(
                f'("{column}" IS NOT NULL)::int' for column in table.one_parent_of) + " <> 1"))
        if table.primary_key:
            keys = ", ".join(f'"{column}"' for column in table.primary_key)
            add(name, "primary key",
                f"SELECT count(*) FROM (SELECT {keys} FROM {name}_stored GROUP BY {keys} HAVING count(*) > 1)")
        for columns, parent, parent_columns in table.references:
            if parent in table_sql:
                present = " AND ".join(f'c."{column}" IS NOT NULL' for column in columns)
                same = " AND ".join(f'p."{b}" = c."{a}"' for a, b in zip(columns, parent_columns))
                add(name, f"reference to {parent}",
                    f"SELECT count(*) FROM {name}_stored c WHERE {present} AND NOT EXISTS "
                    f"(SELECT 1 FROM {parent}_stored p WHERE {same})")
    return f"WITH {rows_sql}, {views} " + " UNION ALL ".join(parts)

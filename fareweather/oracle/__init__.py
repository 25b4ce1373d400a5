"""DuckDB SQL that each query must equal."""

from .statements import SQL


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

"""Independent DuckDB SQL for every registered query (the correctness oracle)."""


def oracle_sql() -> dict[str, str]:
    from . import queries as q

    for optional in ("queries_star", "queries_checks", "queries_io", "queries_native"):
        try:
            __import__(f"{__package__}.{optional}")
        except ModuleNotFoundError as exc:
            if exc.name != f"{__package__}.{optional}":
                raise
    return dict(q.SQL)

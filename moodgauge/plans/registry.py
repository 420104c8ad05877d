"""Names of the registered queries, their functions and their SQL checks."""

QUERIES: dict = {}
SQL: dict = {}


def query(name: str, sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame, with the SQL that gives the same rows."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register

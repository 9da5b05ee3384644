"""All queries of the reference's own operators, with their SQL."""

from . import queries as _queries
from . import sql


def queries() -> dict:
    return dict(_queries.QUERIES)


def oracle_sql() -> dict:
    return sql.oracle_sql()

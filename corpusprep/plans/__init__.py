"""The registered queries and the SQL each is checked against."""

from corpusprep.plans import batches, files, losses, model, runs, streams, text, vectors

_PARTS = (text, batches, losses, model, runs, vectors, files, streams)


def all_queries() -> dict:
    return {name: query for part in _PARTS for name, query in part.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, sql in part.SQL.items()}

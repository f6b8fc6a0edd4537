"""Every query of this subpackage, and the SQL of those that SQL can express."""

from . import queries_basic, queries_corpus, queries_suffix, queries_tables

PARTS = (queries_basic, queries_corpus, queries_suffix, queries_tables)
QUERIES = {name: query for part in PARTS for name, query in part.QUERIES.items()}
SQL = {name: text for part in PARTS for name, text in part.SQL.items()}

"""Registered queries, by name.  Each takes (spark, folder of tables) -> DataFrame."""

from . import files, governance, relational, reports, streams

QUERIES = {
    **files.QUERIES,
    **relational.QUERIES,
    **reports.QUERIES,
    **streams.QUERIES,
    **governance.QUERIES,
}

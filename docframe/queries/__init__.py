"""Query catalogue: QUERIES maps a name to (spark, sf_dir) -> DataFrame, ORACLES to the equivalent DuckDB SQL."""

from docframe.queries import documents, fill, layout, loops, matching, pages, structure, text  # noqa: F401  they register their queries
from docframe.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

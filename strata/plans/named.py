"""A stored dimension under a name of the catalog.

The store's versions are folders named by its log, so a table over the folder would show rows of failed or
older versions. :func:`publish` defines a view over exactly the folders of the latest version and
replaces it after each commit; ``spark.table(name)`` then equals ``store.read()``, for every session of the catalog.
"""

from __future__ import annotations

from strata.constants import IS_CURRENT
from strata.plans.store import ATTEMPT, Commit, DimensionStore


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def publish(store: DimensionStore, name: str, comment: str = "") -> None:
    """Define (or replace) the view ``name`` (dotted for another database) as the store's latest version."""
    commits = store.commits()
    if not commits:
        raise ValueError("store is empty")
    last = commits[-1]
    columns = ", ".join(
        f"CAST({_quoted(f.name)} AS {f.dataType.simpleString()}) AS {_quoted(f.name)}" for f in store.schema.fields)
    wanted = ", ".join(f"'{c.attempt}'" for c in commits if last.base <= c.version)
    text = comment.replace("\\", "\\\\").replace("'", "\\'")
    # partition columns: read as text, so that no part of a folder's name is taken for a number
    current, attempt = f"CAST({IS_CURRENT} AS BOOLEAN)", f"CAST({ATTEMPT} AS STRING)"
    store.spark.sql(
        f"CREATE OR REPLACE VIEW {'.'.join(map(_quoted, name.split('.')))} COMMENT '{text}' AS SELECT {columns} "
        f"FROM parquet.{_quoted(store.data_path)} WHERE {attempt} IN ({wanted}) "
        f"AND ({current} IS NOT TRUE OR {attempt} = '{last.attempt}')")


def merge_and_publish(store: DimensionStore, incoming, name: str, comment: str = "", **options) -> Commit:
    """:meth:`DimensionStore.merge`, then :func:`publish`."""
    commit = store.merge(incoming, **options)
    publish(store, name, comment)
    return commit

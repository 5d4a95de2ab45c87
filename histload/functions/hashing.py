"""Row hashes used to recognise keys and changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from histload.names import quoted


def row_hash(columns: Sequence[str], null_token: str | None = None) -> Column:
    """SHA-256 (hex) of the columns' text joined with ``|``.

    NULLs are left out of the text, so (``a``, NULL) and (NULL, ``a``) hash alike. With
    ``null_token`` every NULL is written as that token and the two differ; hashes made
    with and without a token are not comparable.
    """
    parts = [F.col(quoted(name)) for name in columns]
    if null_token is not None:
        parts = [F.coalesce(part.cast("string"), F.lit(null_token)) for part in parts]
    return F.sha2(F.concat_ws("|", *parts), 256)

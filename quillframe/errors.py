"""The one exception type raised for requests that cannot be carried out."""

from __future__ import annotations


class TableError(ValueError):
    """A request that does not fit the table it was made for; the message says why."""

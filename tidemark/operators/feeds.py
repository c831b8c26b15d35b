"""Change feeds: what happened to a versioned table since a consumer last looked, each change exactly once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.changes import change_stream
from tidemark.operators.incremental import StateFolder


class ChangeFeed:
    """Net changes of a table of numbered versions for one consumer.

    The consumer's offset is the version up to which it has seen everything, 0 before the first. A round reads the
    changes from the offset to the newest version, hands them to the consumer, and publishes the new offset only after
    the consumer's write came back. Where that write, or the publishing, fails, the next round starts from the old
    offset again; ``since`` names the round, so a consumer that overwrites by it repeats nothing.

    Rows: the table's columns, ``action`` (INSERT or DELETE), ``is_update`` (both rows of a changed key), ``since`` and
    ``until``. A row that came and went between two rounds does not show. The table must keep the version at the offset;
    the round fails if it is gone, rather than losing changes.
    """

    def __init__(self, table: StateFolder, keys: Sequence[str], path: str):
        self.table, self.keys = table, list(keys)
        self.spark = table.spark
        self._offsets = StateFolder(table.spark, path)

    def offset(self) -> int:
        """Version that the consumer has seen; offsets are commits named by it."""
        return max(self._offsets.versions().values(), default=0)

    def changes(self, since: int, until: int) -> DataFrame:
        """Changes between two versions; version 0 is the table before its first row."""
        held = self.table.versions()
        for version in (since, until):
            if version and version not in held:
                raise ValueError(f"version {version} is no longer kept")
        after = self.table.read(until)
        before = self.table.read(since) if since else after.limit(0)
        found = change_stream(before, after, self.keys)
        return found.select("*", F.lit(since).alias("since"), F.lit(until).alias("until"))

    def consume(self, write: Callable[[DataFrame, int], None]) -> int:
        """One round: ``write(changes, since)``, then the new offset. Returns the offset; without news nothing is written."""
        since, until = self.offset(), max(self.table.versions(), default=0)
        if until > since:
            write(self.changes(since, until), since)
            self._offsets.commit(self.spark.createDataFrame([(until,)], "version bigint"), batch_id=until, keep=2)
        return until


def append_changes(path: str) -> Callable[[DataFrame, int], None]:
    """A consumer that keeps every round's changes in a folder; a repeated round overwrites itself."""

    def write(changes: DataFrame, since: int) -> None:
        changes.write.mode("overwrite").parquet(f"{path.rstrip('/')}/round={since}")

    return write

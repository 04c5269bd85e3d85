"""Streams whose detectors follow a remote catalogue."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from wardstone.operators.redact import redact_pii
from wardstone.sources.catalogue import Detector, builtin_catalogue, sync_catalogue


class LiveCatalogue:
    """The last catalogue that could be read; starts with the built-in one."""

    def __init__(self, read_remote: Callable[[], DataFrame | None], keep_builtin: bool = False):
        self._read = read_remote
        self._keep_builtin = keep_builtin
        self.current: list[Detector] = builtin_catalogue()
        self.last_error: str | None = None

    def refresh(self) -> list[Detector]:
        """Reads again; a failed, empty or unusable list leaves the current catalogue in place."""
        try:
            self.current = sync_catalogue(self._read(), self.current, self._keep_builtin)
            self.last_error = None
        except Exception as error:  # noqa: BLE001 - whatever failed, the last good list stays
            self.last_error = str(error)
        return self.current


def redact_stream(
    source: DataFrame, text_col: str, catalogue: LiveCatalogue, write: Callable[[DataFrame, int], None], checkpoint: str
):
    """Redacts each micro-batch with the catalogue as it is then, and hands it to ``write``."""

    def batch(df: DataFrame, batch_id: int) -> None:
        write(redact_pii(df, text_col, catalogue.refresh()), batch_id)

    return source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).start()

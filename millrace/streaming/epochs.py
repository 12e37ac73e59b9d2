"""Progress of a file stream in epochs, each of which may forget the files of the one before.

Spark remembers every file that a stream has loaded, on the driver and in the checkpoint, for as long as
the stream may see it again. Once all files of a stream are loaded and moved out of its folder there is
nothing to remember: a new epoch begins with an empty checkpoint.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import SparkSession

from millrace import storage
from millrace.sources.schemas import LEDGER
from millrace.streaming.jobs import stream_id

# Files that are moved at the same time, as a move is mostly waiting for the store.
MOVERS = 16


@dataclass(frozen=True)
class Epochs:
    """The epochs under one checkpoint. The first one lies in the folder itself, the n-th in ``epochs/n``."""

    spark: SparkSession
    root: str

    def current(self) -> str:
        """Folder of the epoch that goes on."""
        number = self._number()
        return f"{self.root}/epochs/{number}" if number else self.root

    def ledger(self, checkpoint: str, batch_id: int) -> str:
        """Where the names of a batch's files are kept."""
        return f"{checkpoint}/files/{batch_id}"

    def check_outside(self, archive: str, path: str) -> None:
        """Refuse an archive that the stream of ``path`` would read again."""
        inner, outer = (storage.qualified_path(self.spark, p).rstrip("/") + "/" for p in (archive, path))
        if inner.startswith(outer):
            raise ValueError(f"the archive {archive} lies in the folder {path} that it is to empty")

    def retire(self, archive: str) -> bool:
        """Move the loaded files of the current epoch to ``archive`` and begin the next one; false if there is
        nothing to move or a batch is not loaded yet.

        A repeated call after a failure goes on where the last one stopped. Files go to a folder named by the
        stream, so a name that was used before is no matter. A file that is not there any more is passed
        over, and so is one of another date or size under its name: it has arrived since.
        """
        epoch = self.current()
        begun, done = self._last(epoch, "offsets"), self._last(epoch, "commits")
        if done is None:
            return False
        batches = [b for b in range(done + 1) if storage.exists(self.spark, f"{self.ledger(epoch, b)}/_SUCCESS")]
        there = f"{archive.rstrip('/')}/{stream_id(self.spark, epoch)}"
        for batch in batches:
            self._move(self.ledger(epoch, batch), there)
        # Files of a batch without a ledger, or of one that is not loaded yet, are still in the folder.
        if begun != done or len(batches) != done + 1:
            return False
        self._open(self._number() + 1)
        return True

    def _move(self, ledger: str, there: str) -> None:
        files = self.spark.read.schema(LEDGER).parquet(ledger).select("path", "modified", "length")
        names = files.toLocalIterator(prefetchPartitions=False)

        def move(row) -> None:
            to = there + storage.path_in_store(self.spark, row.path)
            storage.move(self.spark, row.path, to, row.modified, row.length)

        with ThreadPoolExecutor(MOVERS) as pool:
            waiting = []
            for row in names:
                waiting.append(pool.submit(move, row))
                if len(waiting) >= 64 * MOVERS:
                    for moved in waiting:
                        moved.result()
                    waiting = []
            for moved in waiting:
                moved.result()

    def _open(self, number: int) -> None:
        """Begin an epoch, in one step, and delete what is left of those before."""
        storage.make_dir(self.spark, f"{self.root}/epochs/{number}")
        for name in storage.folder_names(self.spark, f"{self.root}/epochs"):
            if int(name) < number:
                storage.delete(self.spark, f"{self.root}/epochs/{name}")
        for name in ("offsets", "commits", "sources", "files", "metadata"):
            storage.delete(self.spark, f"{self.root}/{name}")

    def _number(self) -> int:
        folder = f"{self.root}/epochs"
        names = storage.folder_names(self.spark, folder) if storage.exists(self.spark, folder) else []
        return max((int(name) for name in names), default=0)

    def _last(self, epoch: str, log: str) -> int | None:
        """The last batch in one of the stream's logs."""
        folder = f"{epoch}/{log}"
        names = storage.file_names(self.spark, folder) if storage.exists(self.spark, folder) else []
        return max((int(name) for name in names if name.isdigit()), default=None)

"""Stage tables: results written once to the shared folder and read back.

A later step that reads its input more than once (quantiles, model fits, global ranks) takes a
stage table, so the upstream plan runs once and a lost executor only costs a re-read. The folder
is the one the session names in ``spark.checkpoint.dir``. Inside ``scratch`` all of them lie in one folder that
is deleted at the end.

A ``Run`` keeps the manifest of a batch in its output folder: which tables are whole. Tables are written
beside their place, moved there when they are complete and only then listed, so a run that was killed goes on
after its last whole step.
"""

import hashlib
import json
import math
import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

TASK_LINES = 200_000  # lines held by one task


def parts_for(lines: DataFrame) -> int | None:
    """Into how many partitions lines go so that a task holds about ``TASK_LINES`` of them, at least as many as
    the session shuffles to; None if one task holds them all. Counts the lines."""
    rows = lines.count()
    if rows <= TASK_LINES:
        return None
    return max(math.ceil(rows / TASK_LINES), int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only for a local session that has none."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="shoplens-"))
    return context.getCheckpointDir()


_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


def stage_path(spark: SparkSession, name: str) -> str:
    folder = _SCRATCH.get() or shared_folder(spark).rstrip("/")
    return f"{folder}/shoplens-{name}-{uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """Stage tables written inside go to one folder of this name; it is deleted at both ends, since a killed
    run of the same name may have left its own. What is kept must have been written elsewhere by then."""
    folder = f"{shared_folder(spark).rstrip('/')}/shoplens-run-{name}"
    delete(spark, folder)
    token = _SCRATCH.set(folder)
    try:
        yield folder
    finally:
        _SCRATCH.reset(token)
        delete(spark, folder)


def store(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` as Parquet under the shared folder and return a reader of that table."""
    spark = frame.sparkSession
    path = stage_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


# ---- files ---------------------------------------------------------------------------------------


def _place(spark: SparkSession, path: str):
    """The file system of a path, whatever it is, and the path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def delete(spark: SparkSession, path: str) -> None:
    system, place = _place(spark, path)
    system.delete(place, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """``source`` in the place of ``target``."""
    system, new = _place(spark, target)
    system.delete(new, True)
    system.mkdirs(new.getParent())
    if not system.rename(_place(spark, source)[1], new):
        raise OSError(f"{source} cannot be moved to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    system, place = _place(spark, path)
    stream = system.create(place, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    system, place = _place(spark, path)
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


# ---- runs ----------------------------------------------------------------------------------------


def input_key(frame: DataFrame, *settings: object) -> str:
    """A name for a run over these files as they are now and with these settings; of its own for input that
    does not come from files."""
    spark = frame.sparkSession
    files = []
    for path in sorted(frame.inputFiles()):
        system, place = _place(spark, path)
        status = system.getFileStatus(place)
        files.append((path, status.getLen(), status.getModificationTime()))
    return hashlib.sha256(repr((files or uuid4().hex, settings)).encode()).hexdigest()[:24]


class Run:
    """The steps of a batch that are whole, in ``folder``/_manifest/``key``."""

    def __init__(self, spark: SparkSession, folder: str, key: str):
        self.spark, self.folder, self.key = spark, folder.rstrip("/"), key
        self.paths: dict[str, str] = {}

    def step(
        self, name: str, make: Callable[[], dict[str, DataFrame]], done: Callable[[str, DataFrame], None] | None = None
    ) -> dict[str, DataFrame]:
        """The tables of a step, read back: made and written, or as an earlier run of this key left them.

        ``done`` is called with each table that was written now.
        """
        spark, entry = self.spark, f"{self.folder}/_manifest/{self.key}/{name}.json"
        listed = read_text(spark, entry)
        made = listed is None
        if made:
            tables = make()
            for table, frame in tables.items():
                frame.write.mode("overwrite").parquet(f"{self.folder}/_draft/{self.key}/{table}")
            for table in tables:
                move(spark, f"{self.folder}/_draft/{self.key}/{table}", f"{self.folder}/{table}")
            names = list(tables)
        else:
            names = json.loads(listed)
        paths = {table: f"{self.folder}/{table}" for table in names}
        found = {table: spark.read.parquet(path) for table, path in paths.items()}
        if made:
            for table, frame in found.items():
                if done:
                    done(table, frame)
            write_text(spark, entry, json.dumps(names))
        self.paths |= paths
        return found

    def finish(self) -> None:
        """Only the tables stay."""
        for rest in ("_draft", "_manifest"):
            delete(self.spark, f"{self.folder}/{rest}")

"""Files and folders beside a table: where loads write, and what is listed, read and removed there."""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekeel.sources.target import TargetState
from tablekeel.spec import LoadSpec

log = logging.getLogger(__name__)

LOADS = "__loads"
#: Files that are being moved at a time.
THREADS = 8


def table_folder(spark: SparkSession, state: TargetState | None, spec: LoadSpec | None = None) -> str:
    """The table's first folder, wherever a load has put its present files."""
    if state is not None:
        return state.location.rstrip("/").split(f"{LOADS}/")[0]
    return f"{spark.catalog.getDatabase(spec.target_schema).locationUri.rstrip('/')}/{spec.table}"


def new_folder(spark: SparkSession, state: TargetState | None, spec: LoadSpec | None = None) -> str:
    return f"{table_folder(spark, state, spec)}{LOADS}/{uuid.uuid4().hex[:12]}"


def normal(location: str | None) -> str | None:
    """A folder's name in one spelling, so that two can be compared."""
    return location and re.sub("^file:/+", "file:/", location.rstrip("/"))


def escaped(name: str) -> str:
    """A name as it stands in a partition's folder. The characters that are escaped there."""
    special = "\"#%'*/:=?\\\x7f{[]^"
    return "".join(f"%{ord(c):02X}" if c in special or ord(c) < 32 else c for c in name)


def _open(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def delete(spark: SparkSession, folders: Sequence[str]) -> None:
    """Remove folders that nothing refers to any more; what stays behind does no harm but takes space."""
    for folder in folders:
        try:
            path, files = _open(spark, folder)
            files.delete(path, True)
        except Exception:
            log.warning("could not remove %s", folder, exc_info=True)


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names of what is in a folder; nothing for a folder that is not there."""
    path, files = _open(spark, folder)
    return [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []


def delete_replaced(spark: SparkSession, folders: Sequence[str]) -> None:
    """Remove folders, and the folder of a load when no partition of it is left."""
    delete(spark, folders)
    for above in {f.rstrip("/").rpartition("/")[0] for f in folders}:
        if above.rpartition("/")[0].endswith(LOADS) and not any("=" in name for name in children(spark, above)):
            delete(spark, [above])


def write_text(spark: SparkSession, file: str, text: str) -> None:
    """A small file, which is there in full or not at all."""
    path, files = _open(spark, file)
    part, _ = _open(spark, f"{file}.{uuid.uuid4().hex[:8]}.part")
    out = files.create(part, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not files.rename(part, path):
        files.delete(part, False)
        raise OSError(f"could not write {file}")


def read_text(spark: SparkSession, file: str) -> str:
    path, files = _open(spark, file)
    source = files.open(path)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode()
    finally:
        source.close()


def move(spark: SparkSession, names: Sequence[str], source: str, to: str, if_there: bool = False) -> None:
    """Move files from one folder to another, or those of them that are there; what has been moved already stays."""
    if not names:
        return
    path, files = _open(spark, to)
    files.mkdirs(path)

    def one(name: str) -> None:
        old, new = (spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}") for folder in (source, to))
        if files.exists(new) or if_there and not files.exists(old):
            return
        if not files.rename(old, new):
            raise OSError(f"could not move {old.toString()} to {to}")

    with ThreadPoolExecutor(THREADS) as pool:
        list(pool.map(one, names))


def file_names(spark: SparkSession, folders: Sequence[str]) -> dict[str, frozenset[str]]:
    """The names of the data files in each of the folders, and in the folders below them."""
    found: dict[str, set[str]] = {normal(f): set() for f in folders}
    if folders:
        for row in listed_files(spark, folders).select("folder", "name").toLocalIterator():
            found.setdefault(row.folder, set()).add(row.name)
    return {folder: frozenset(names) for folder, names in found.items()}


def listed_files(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """``folder, name, length`` of every file below the folders; a listing, which opens no file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(folders))
    folder = F.regexp_replace(F.regexp_replace("path", "/[^/]+$", ""), "^file:/+", "file:/")
    return files.select(folder.alias("folder"), F.regexp_extract("path", "[^/]+$", 0).alias("name"), "length")

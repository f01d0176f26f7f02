"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import scratch_dir
from quire.sources.store import delete_tree

#: A cut before a space between two ASCII letters never crosses a word, a contraction or
#: a special string, so pieces of a text cut there tokenise as the whole text does.
SAFE_CUT = re.compile(r"(?<=[a-z])(?= [a-z])")
#: A space between two characters that are not white space.
LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_ROWS = 1000    # rows of an Arrow batch: texts are long, and a worker holds a batch


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (clusters whose
    executors do not see that folder ship the package with ``--py-files`` instead), and hand
    them fewer rows at a time than Spark does unless told otherwise."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))


_FOLDERS: list[str] = []     # of the runs that are going on, the innermost last


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, or under the folder of the run that is going on."""
    path = scratch_dir(spark, name)
    return f"{_FOLDERS[-1]}/{os.path.basename(path)}" if _FOLDERS else path


@contextmanager
def run_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder for everything written inside the block, deleted after it: only for blocks whose result has been
    written elsewhere."""
    folder = scratch(spark, name)
    _FOLDERS.append(folder)
    try:
        yield folder
    finally:
        _FOLDERS.remove(folder)
        delete_tree(spark, folder)


def unused(df: DataFrame, name: str) -> str:
    """A column name that a table does not have (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def written(df: DataFrame, name: str) -> DataFrame:
    """Write rows that feed several consumers to shared scratch Parquet and read them back."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """True for the third of rows that nothing may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def file_bytes(path: str, most: int = 64 << 20) -> bytes:
    """A vocabulary file, read on the driver; refused beyond ``most`` bytes because it is broadcast."""
    with open(path, "rb") as f:
        data = f.read(most + 1)
    if len(data) > most:
        raise ValueError(f"{path} is over {most} bytes")
    return data


def safe_blocks(text: str, limit: int = 1 << 20):
    """Cut a text into blocks of about ``limit`` characters at safe places only."""
    start = 0
    while len(text) - start > limit:
        cut = SAFE_CUT.search(text, start + limit)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def sized(df: DataFrame, most: int = 200_000) -> DataFrame:
    """Written narrow rows, to be broadcast if there are at most ``most`` of them; beyond that
    Spark joins by shuffling."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df

"""What the operators share: cut lineage, shared folders, words."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

WORD = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package's code to the executors once per application, as ``--py-files`` would."""
    context, root = spark.sparkContext, Path(__file__).resolve().parents[2]
    if context.applicationId in _shipped or not (root / "rivermill").is_dir():
        return
    folder = tempfile.mkdtemp(prefix="rivermill-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = f"{folder}/rivermill-code.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted((root / "rivermill").rglob("*.py")):
            out.write(path, path.relative_to(root))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; a folder of this run where unset (tests)."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        named = tempfile.mkdtemp(prefix="rivermill-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, so that a lost executor repeats nothing above it."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def kept(df: DataFrame, name: str) -> DataFrame:
    """As ``cut``, as a Parquet table: smaller for many rows. The folder stays until the cluster clears it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/rivermill/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) that depends on ``seed`` and ``parts`` alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *parts), 11) / F.lit(float(1 << 53))


def map_texts(
    docs: DataFrame, make: Callable[[], Callable[[str], tuple]], fields: str, key: str = "doc_id"
) -> DataFrame:
    """``key`` and what ``make()`` gives for each text (null: empty), in Arrow batches. ``fields``: DDL of the results."""
    rows = docs.select(docs[key], docs["text"])
    schema = StructType([rows.schema[key], *StructType.fromDDL(fields).fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            results = [work(text.as_py() or "") for text in batch.column(1)]
            made = [pa.array(c, f.type) for c, f in zip(zip(*results, strict=True), list(arrow)[1:], strict=True)]
            if results:
                yield pa.RecordBatch.from_arrays([batch.column(0), *made], schema=arrow)

    return rows.mapInArrow(run, schema)

"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from ..session import checkpoint_dir, configure, ship_package

# The two word classes of the contracts, as Java/DuckDB regex classes.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
TOKEN_PATTERN = r"[^\x20\x09-\x0D]+"
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACES = " \t\n\x0b\x0c\r"

# bytes.translate table: lower-cases A-Z, keeps 0-9 a-z and every byte of a
# non-ASCII character, turns every other ASCII byte into a space.
WORD_TABLE = bytes((c + 32 if 65 <= c <= 90 else c)
                   if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 else 32
                   for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Words of class WORD_PATTERN after lower-casing A-Z; UTF-8 in, UTF-8 out."""
    return text.translate(WORD_TABLE).split() if text else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ready(spark: SparkSession) -> SparkSession:
    """Session options, and the package on every worker."""
    configure(spark)
    ship_package(spark)
    # Batches of texts must fit beside the heap.  Plans read these options when they run, so they stay set.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    return spark


def _folder(spark: SparkSession, path: str):
    """The path and its file system, as Hadoop objects."""
    jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(jsc.hadoopConfiguration())


def scratch(spark: SparkSession, tag: str) -> str:
    """A path to be written under the shared checkpoint folder; it is deleted when the driver ends, if not by discard()."""
    top = f"{checkpoint_dir(spark)}/llm-{tag}-{uuid.uuid4().hex}"
    folder, files = _folder(spark, top)
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    for held in _HELD:
        held.append(top)
    return f"{top}/data"


def discard(spark: SparkSession, path: str) -> None:
    """Delete what was written at a path of scratch()."""
    folder, files = _folder(spark, path.removesuffix("/data"))
    files.delete(folder, True)


_HELD: list[list[str]] = []


@contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """Deletes, at the end of the block, all scratch paths made in it: for jobs whose output is written by then."""
    made: list[str] = []
    _HELD.append(made)
    try:
        yield
    finally:
        _HELD.remove(made)
        for path in made:
            discard(spark, path)


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.  `lower` does exactly that on pure ASCII text."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and use it many times inside `body`."""
    return F.transform(F.array(value), body)[0]


KEPT: list[Callable[[], None]] = []   # frees what a module keeps in a worker process between tasks


def tidy() -> None:
    """Called where a task begins or ends: gives back what operators of other stages left in this worker process."""
    for free in KEPT:
        free()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):                        # not glibc: nothing to give back
        pass


def map_texts(df: DataFrame, keep: list[str], text_col: str, fields: list[StructField],
              make: Callable[[], Callable[[list], list]]) -> DataFrame:
    """One output row per input row: the `keep` columns, then `fields`.

    `make()` runs once per task and returns a function from the UTF-8 texts of
    a batch (None for null) to one list per field.
    """
    src = df.select(*keep, F.col(text_col).cast("string").alias("__text"))
    schema = StructType([*src.schema.fields[:len(keep)], *fields])
    arrow, n = to_arrow_schema(schema), len(keep)

    def run(batches):
        tidy()
        fn = make()
        for b in batches:
            col = b.column(n)
            texts = col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()).to_pylist()
            made = fn(texts)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i).cast(arrow.field(i).type) for i in range(n)),
                 *(pa.array(c, arrow.field(n + i).type) for i, c in enumerate(made))], schema=arrow)

    return src.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels no classifier here learns from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0

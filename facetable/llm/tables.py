"""Small helpers that several operators share."""

from __future__ import annotations

import pathlib
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from facetable.session import scratch_path, shared_folder

#: White space that separates words: space, tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package's code to the Python workers, once per application.

    A session that was started elsewhere may have workers that cannot import it.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        package = pathlib.Path(__file__).resolve().parents[1]
        archive = pathlib.Path(tempfile.mkdtemp(prefix="facetable-code-")) / "facetable_code.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, str(file.relative_to(package.parent)))
        context.addPyFile(str(archive))  # Spark serves it to the executors


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One input table by its folder."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether a document is kept from training: by crc32 of its id as text.

    A NULL id is in no fold.
    """
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def words_of(text: Column) -> Column:
    """The words of a text in order; NULL has none.

    White space becomes blanks first: splitting by one plain character needs no
    regular expression, which takes a third of the time.
    """
    plain = F.coalesce(text, F.lit(""))
    for space in "\t\n\x0b\x0c\r":
        plain = F.replace(plain, F.lit(space), F.lit(" "))
    return F.array_remove(F.split(plain, " "), "")


def fixed(value: Column) -> Column:
    """The same value, computed where it stands.

    A filter on a computed column is otherwise moved below it, with the whole
    computation copied into the condition, once for every use.
    """
    return F.when(F.monotonically_increasing_id() >= 0, value)  # always so, and never moved


def unused(taken: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores as make it new."""
    lower = {c.lower() for c in taken}
    out = []
    for name in names:
        while name.lower() in lower:
            name += "_"
        out.append(name)
        lower.add(name.lower())
    return out


def partitions(spark: SparkSession) -> int:
    """The number of shuffle partitions the session asks for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def checkpointed(rows: DataFrame) -> DataFrame:
    """``rows`` in the checkpoint folder, which is the shared one if none is set."""
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(rows.sparkSession))
    return rows.checkpoint()


def settled(rows: DataFrame) -> DataFrame:
    """``rows`` written to the shared folder and read again.

    Unlike a checkpoint, which keeps the estimates of the plan it came from, the result
    has the size of its files; in loops those estimates would multiply without end.
    """
    path = scratch_path(rows.sparkSession, "step")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)

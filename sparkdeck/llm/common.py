"""Shared expressions: words, ASCII lower case, table reads, literal arrays."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkdeck.session import shared_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: Separators between words before and after lower-casing A-Z: every ASCII
#: character that is neither a digit nor a letter (all other characters are
#: part of words).
SEPARATORS_RAW = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: A character of a word.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"

#: crc32(doc_id as text) mod 3 equal to this is held out of all training.
HELD_OUT_REMAINDER = 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, every other character unchanged.  ``lower`` does just this
    to a text of ASCII characters, several times faster than ``translate``."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def raw_words(text: Column) -> Column:
    """Words of a text in their own case.  ``split`` by separators is linear in
    the text (one regular-expression match object per match is not)."""
    return F.array_remove(F.split(text, SEPARATORS_RAW), "")


def words(text: Column) -> Column:
    """Words of a text (null: none) after lower-casing A-Z."""
    return raw_words(ascii_lower(F.coalesce(text, F.lit(""))))


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the decimal id leaves remainder 1; a null id counts
    as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == HELD_OUT_REMAINDER


def saved(df: DataFrame, name: str) -> DataFrame:
    """Writes a frame to the shared folder and reads it back: the lineage ends
    there, and a lost executor takes nothing with it."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hash_below(c: Column, wanted: int, rows: int, margin: int = 4) -> Column:
    """True for about ``margin * wanted`` of ``rows`` rows, those whose hash of
    ``c`` is smallest: a cheap first cut before taking the ``wanted`` smallest."""
    if rows <= margin * wanted:
        return F.lit(True)
    return F.xxhash64(c) < F.lit(int(-(2**63) + 2**64 * (margin * wanted / rows)))


def literal_array(values: list, kind: str) -> Column:
    """A constant array column (folded once per plan, not built per row)."""
    if not values:
        return F.array().cast(f"array<{kind}>")
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")


def fresh(name: str, taken: list[str]) -> str:
    """A column name that does not occur among ``taken`` (in any case)."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name += "_"
    return name


#: DuckDB: the words of a text column.
SQL_WORDS = ("list_filter(string_split_regex(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             "'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Makes this package importable in the Python workers of a session, once
    per application: its sources go to the executors as a Python file of the
    job.  Functions are then pickled by reference, and a worker process keeps
    its module-level memos from task to task."""
    sc = spark.sparkContext
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if sc.applicationId in _SHIPPED or not os.path.isdir(root):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="sparkdeck-py-"), "sparkdeck_sources.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("sparkdeck", os.path.relpath(full, root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)

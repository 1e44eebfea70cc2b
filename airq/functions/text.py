"""Text expressions for file names, list texts and column names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: names of hourly product archives.
ARCHIVE_PATTERN = r"(stundenwerte_[A-Za-z0-9_]+\.zip)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def last_number_of_list(c: str | Column) -> Column:
    """``[9.1, 9.2]`` or ``9.2`` to 9.2; null when there is no number."""
    bare = F.regexp_replace(_col(c), r"[\[\]]", "")
    return F.trim(F.element_at(F.split(bare, ","), -1)).try_cast("double")


def archive_name(c: str | Column) -> Column:
    """The archive file name inside a listing line; null when there is none."""
    found = F.regexp_extract(_col(c), ARCHIVE_PATTERN, 1)
    return F.when(found != "", found)


def station_id_from_name(c: str | Column) -> Column:
    """The five-digit station number between underscores; null when there is none."""
    return F.regexp_extract(_col(c), r"_(\d{5})_", 1).try_cast("int")


def station_tag(c: str | Column) -> Column:
    """Station number as it is written inside an archive name."""
    return F.format_string("_%05d_", _col(c))


def _allowed_in_name(c: str) -> bool:
    return c in "-._" or c.isalnum()


def sanitise_name(name: str) -> str:
    """Column name without surrounding white space, with underscores for blanks, and only letters, digits, ``-``, ``.`` and ``_``."""
    joined = "_".join(str(name).strip().split(" "))
    return "".join(c for c in joined if _allowed_in_name(c))


def sanitise_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[sanitise_name(c) for c in df.columns])

"""Patterns and parsing of text columns: dates, names, file keys, statuses, coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from demandlake.spec import ITEM_METADATA, RELATED_TIME_SERIES, TARGET_TIME_SERIES

# Accepted input timestamps, generator start dates, and dataset names.
INPUT_TIME_PATTERN = (
    r"^\d{4}-\d{1,2}-\d{1,2}$|^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"
)
START_DATE_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$|^\d{4}-\d{2}-\d{2}$"
NAME_PATTERN = r"^[a-zA-Z][\p{L}\p{N}_]{0,62}$"


def is_input_timestamp(text: Column) -> Column:
    return text.rlike(INPUT_TIME_PATTERN)


def start_date(text: Column) -> Column:
    """Text in one of the two padded formats as a timestamp, null when malformed or impossible."""
    return F.when(text.rlike(START_DATE_PATTERN), text.try_cast("timestamp"))


def is_valid_name(text: Column) -> Column:
    """A Latin letter, then up to 62 letters, digits or underscores of any script."""
    return text.rlike(NAME_PATTERN)


# -- file keys ---------------------------------------------------------------------------


def file_name(key: Column) -> Column:
    return F.substring_index(key, "/", -1)


def file_prefix(key: Column) -> Column:
    """File name up to its first dot: the dataset group the file belongs to."""
    return F.substring_index(file_name(key), ".", 1)


def delivered_file(path: Column) -> Column:
    """The file or folder that was delivered: the path up to its first part named ``*.csv``.

    Found by a plain search, since a pattern over a long path takes longer than the parsing of a line.
    """
    end = F.locate(".csv/", path)
    return F.when(end > 0, F.substring(path, F.lit(1), end + 3)).when(path.endswith(".csv"), path).otherwise("")


def dataset_type(key: Column) -> Column:
    return (
        F.when(key.endswith(".related.csv"), RELATED_TIME_SERIES)
        .when(key.endswith(".metadata.csv"), ITEM_METADATA)
        .otherwise(TARGET_TIME_SERIES)
    )


def dataset_name(key: Column) -> Column:
    suffix = (
        F.when(key.endswith(".related.csv"), "_related")
        .when(key.endswith(".metadata.csv"), "_metadata")
        .otherwise("")
    )
    return F.concat(file_prefix(key), suffix)


def url_bucket(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-z0-9]+://([^/]*)", 1)


def url_key(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-z0-9]+://[^/]*/*(.*)$", 1)


def url_folder(url: Column) -> Column:
    """Everything up to and including the last slash."""
    return F.regexp_extract(url, r"^(.*/)[^/]*$", 1)


def decoded_key(key: Column) -> Column:
    """Undo URL encoding; a malformed escape leaves null instead of failing the batch."""
    return F.try_url_decode(key)


# -- statuses ----------------------------------------------------------------------------


def is_active(status: Column) -> Column:
    return status == "ACTIVE"


def is_updating(status: Column) -> Column:
    return status.contains("PENDING") | status.contains("IN_PROGRESS")


def is_failed(status: Column) -> Column:
    return status.contains("FAILED")


# -- coordinates -------------------------------------------------------------------------


def latitude(text: Column) -> Column:
    return _coordinate(text, 0, 90.0)


def longitude(text: Column) -> Column:
    return _coordinate(text, 1, 180.0)


def _coordinate(text: Column, position: int, limit: float) -> Column:
    """One half of ``latitude_longitude`` text, null unless both halves exist and it is in range."""
    parts = F.split(text, "_")
    value = F.get(parts, position).try_cast("double")
    return F.when((F.size(parts) == 2) & value.between(-limit, limit), value)


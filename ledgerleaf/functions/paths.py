"""Path pieces and destination keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_name(path: Column) -> Column:
    """Everything after the last slash."""
    return F.substring_index(path, "/", -1)


def file_extension(name: Column) -> Column:
    """Upper-case text after the last dot, empty when there is no dot."""
    return F.when(F.contains(name, F.lit(".")), F.upper(F.substring_index(name, ".", -1))).otherwise(F.lit(""))


def part(path: Column, n: int, delimiter: str = "/") -> Column:
    """n-th piece, 1-based; negative n counts from the end; empty when out of range."""
    return F.split_part(path, F.lit(delimiter), F.lit(n))


def account_folder(path: Column) -> Column:
    """The folder that holds the file: the last piece but one."""
    return part(path, -2)


def validated_key(account: Column, name: Column) -> Column:
    return F.concat_ws("/", F.lit("validated"), account, name)


def quarantine_key(reason: Column, name: Column) -> Column:
    return F.concat_ws("/", F.lit("quarantine"), reason, name)


def stage_key(stage: Column, path: Column) -> Column:
    return F.concat(F.lit("@"), stage, F.lit("/"), part(path, -1))


def archive_key(account: Column, file_id: Column, name: Column) -> Column:
    """Account and file id keep equal names from colliding."""
    return F.concat_ws("/", F.lit("archive"), account, file_id, name)

"""Numbered manifests: which immutable folders make up a table.

A manifest is a JSON object in ``<root>/<number>.json``. It is written beside its
place and renamed into it, which fails where the number is taken: a reader finds
the old manifest or the new one, a crash leaves the old one, and of two writers
that started from one manifest only the first succeeds.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from clickweir import workspace

# How many manifests stay, for readers that took one just before it was replaced.
KEPT = 2
_DIGITS = 12


def _numbers(spark: SparkSession, root: str) -> list[int]:
    if not workspace.exists(spark, root):
        return []
    names = (name.partition(".") for name in workspace.list_dir(spark, root))
    return sorted(int(stem) for stem, _, kind in names if kind == "json" and stem.isdigit())


def _path(root: str, number: int) -> str:
    return f"{root}/{number:0{_DIGITS}d}.json"


def newest(spark: SparkSession, root: str) -> tuple[int, dict | None]:
    """Number and content of the manifest in force; (0, None) without one."""
    numbers = _numbers(spark, root)
    if not numbers:
        return 0, None
    return numbers[-1], json.loads(workspace.read_text(spark, _path(root, numbers[-1])))


def kept(spark: SparkSession, root: str, keep: int = KEPT) -> list[dict]:
    """The manifests that readers may be using, oldest first."""
    return [json.loads(workspace.read_text(spark, _path(root, n)))
            for n in _numbers(spark, root)[-keep:]]


def commit(
    spark: SparkSession, root: str, based_on: int, content: dict, keep: int = KEPT
) -> None:
    """Put the next manifest in force; FileExistsError if another writer was faster."""
    workspace.write_new_text(spark, _path(root, based_on + 1), json.dumps(content))
    for number in _numbers(spark, root)[:-keep]:
        workspace.delete(spark, _path(root, number))

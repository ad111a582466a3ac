"""Frame names and paths as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def frame_name(number: Column) -> Column:
    return F.format_string("img-%06d", number)


def frame_number(path: Column) -> Column:
    return F.regexp_extract(path, r"img-(\d+)", 1).try_cast("int")


def wanted(name: Column, chosen: list[str]) -> Column:
    """A choice of digits means exactly that frame, any other is searched for in the name; no choice keeps all.

    A choice may list several, with commas between them.
    """
    each = [c.strip() for said in chosen for c in said.split(",") if c.strip()]
    out = F.lit(not each)
    for c in each:
        out = out | (name == F.lit(f"img-{int(c):06d}") if c.isdigit() else name.contains(c))
    return out


def forward_slashes(path: Column) -> Column:
    return F.replace(path, F.lit("\\"), F.lit("/"))


def label_path(root: str, split: Column, number: Column) -> Column:
    folder = F.when(split == "train", "train13labels").otherwise("test13labels")
    return F.concat(F.lit(root.rstrip("/") + "/"), folder, F.format_string("/img13labels-%06d.png", number))

"""Paths, URIs, file names and the ids derived from them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Image suffixes and dataset splits of the request generator.
IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png")
SPLITS = ("train", "test", "val")


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def file_name(path: Column | str) -> Column:
    return F.substring_index(_c(path), "/", -1)


def parent_name(path: Column | str, up: int = 1) -> Column:
    """Name of the folder ``up`` levels above the file; NULL where the path is too short."""
    return F.try_element_at(F.split(_c(path), "/"), F.lit(-1 - up))


def file_stem(path: Column | str) -> Column:
    """File name without its last suffix; a leading dot is part of the name."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]+$", "")


def file_suffix(path: Column | str) -> Column:
    return F.lower(F.regexp_extract(file_name(path), r"(?<=.)(\.[^.]+)$", 1))


def has_suffix(
    path: Column | str, suffixes: Sequence[str] = IMAGE_SUFFIXES, ignore_case: bool = True
) -> Column:
    """True where the path ends in any of the suffixes."""
    p = _c(path)
    if ignore_case:
        p, suffixes = F.lower(p), [s.lower() for s in suffixes]
    return reduce(lambda a, b: a | b, [p.endswith(s) for s in suffixes])


def normalize_path(path: Column | str) -> Column:
    """One spelling for one file, so that both join sides agree.

    ``/a``, ``file:/a``, ``file:///a`` become ``/a``; ``s3a://`` and ``s3n://`` become ``s3://``;
    doubled slashes inside a local path and surrounding blanks go away. In an object store
    ``a//b`` and ``a/b`` are two keys, so a path with a scheme keeps its slashes.
    """
    p = F.trim(_c(path))
    p = F.regexp_replace(p, r"^file:/+(?=[^/]|$)", "/")
    p = F.regexp_replace(p, r"^s3[an]://", "s3://")
    local = ~p.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://")
    return F.when(local, F.regexp_replace(p, r"/{2,}", "/")).otherwise(p)


def uri_container(uri: Column | str) -> Column:
    """Bucket or host of ``scheme://container/key``; empty if there is no scheme."""
    return F.regexp_extract(_c(uri), r"^[A-Za-z0-9]+://([^/]*)", 1)


def uri_key(uri: Column | str) -> Column:
    return F.regexp_extract(_c(uri), r"^[A-Za-z0-9]+://[^/]*/(.*)$", 1)


def object_key(label: Column | str, name: Column | str, prefix: str = "raw_images") -> Column:
    return F.concat_ws("/", F.lit(prefix), _c(label), _c(name))


def object_uri(bucket: str, key: Column | str) -> Column:
    return F.concat(F.lit(f"s3://{bucket}/"), _c(key))


def flat_name(split: Column | str, name: Column | str) -> Column:
    """File name after folding the split folder into it."""
    return F.concat_ws("_", _c(split), _c(name))


def request_id(n: Column | str) -> Column:
    return F.format_string("req_%08d", _c(n))


def run_label(index: Column | str, size: Column | str, unit: str = "reqs") -> Column:
    return F.format_string(f"run_%03d_%d{unit}", _c(index), _c(size))


def short_device(name: Column | str) -> Column:
    return F.substring_index(_c(name), "-", 1)


def study_id(path: Column | str) -> Column:
    """``IM-<digits>`` from the file stem, else a stable five-digit number made from the stem."""
    stem = file_stem(path)
    digits = F.regexp_extract(stem, r"(?i)IM-(\d+)", 1)
    made = F.format_string("STUDY-%05d", F.pmod(F.crc32(stem.cast("binary")), F.lit(100000)))
    return F.when(digits != "", F.concat(F.lit("IM-"), digits)).otherwise(made)


def case_id(path: Column | str) -> Column:
    return F.concat(F.lit("CXR-TRAIN-"), study_id(path))

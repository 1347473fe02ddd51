"""Names of datasets and columns; plain Python over schema-sized lists."""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterable

COPY_SUFFIX = re.compile(r"(_[1-9]|\.x|\.y)$")


def clean_name(name: str) -> str:
    """Snake-case ASCII form of one name; never empty, never led by a digit."""
    text = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode()
    text = re.sub("['\"]", "", text).replace("%", "_percent_").replace("#", "_number_")
    text = re.sub("([a-z0-9])([A-Z])", r"\1_\2", text)
    text = re.sub("[^a-z0-9]+", "_", text.lower()).strip("_")
    return text if text and not text[0].isdigit() else "x" + text


def make_unique(names: Iterable[str]) -> list[str]:
    """Later repeats of a name get _2, _3 ... from left to right."""
    used: set[str] = set()
    counts: dict[str, int] = {}
    result = []
    for name in names:
        candidate = name
        while candidate in used:
            counts[name] = counts.get(name, 1) + 1
            candidate = f"{name}_{counts[name]}"
        used.add(candidate)
        result.append(candidate)
    return result


def clean_names(names: Iterable[str]) -> list[str]:
    return make_unique(clean_name(n) for n in names)


def dataset_name(path: str) -> str:
    """Clean form of the file's basename up to its first dot."""
    return clean_name(os.path.basename(path.rstrip("/")).split(".")[0])


def base_name(name: str) -> str:
    """The name without the mark of a copy (_1 to _9, .x, .y)."""
    return COPY_SUFFIX.sub("", name)

"""From raw datasets to clean ones, with tables of what is wrong with them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from mergewell.functions.cells import as_number, is_numeric_text, is_symbol_only, is_us_date
from mergewell.functions.hashing import feature_hash
from mergewell.functions.naming import clean_name, make_unique
from mergewell.jobs import in_threads
from mergewell.operators.columns import RETYPE_NULLS, scan
from mergewell.operators.counting import mark_duplicated, rename_across_datasets
from mergewell.operators.duplicates import (
    classify_duplicates, copies_to_long, duplicate_evidence, surviving_copies)
from mergewell.operators.keys import get_dupes, has_repeats, number_repeats
from mergewell.sources.delimited import MALFORMED, RawDataset

KEY = "subject_id"
PROBLEMS = ("subject_id_not_found", "subject_id_duplicated", "date_not_unix", "duplicated_data",
            "duplicated_column_names", "data_are_symbols")
LOSSES = ("cells_unlike_header", "subject_id_missing")



@dataclass
class ProfileReport:
    na_counts: DataFrame
    problems: DataFrame
    clean: dict[str, DataFrame]
    evidence: dict[tuple[str, str, str], DataFrame] = field(default_factory=dict)
    duplicate_rows: dict[str, DataFrame] = field(default_factory=dict)
    date_features: dict[str, list[str]] = field(default_factory=dict)
    renames: dict[str, dict[str, str]] = field(default_factory=dict)
    #: (dataset, problem, rows): rows with more or fewer cells than the header, of which cells
    #: beyond it are lost, and rows that are left out because they have no subject.
    losses: DataFrame | None = None


def as_raw(name: str, df: DataFrame) -> RawDataset:
    """A Spark table as raw dataset: positional text columns and its own header."""
    cells = [F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(df.columns)]
    return RawDataset(clean_name(name), df.select(*cells), list(df.columns))


def problem_table(spark: SparkSession, marks: Iterable[tuple[str, str]]) -> DataFrame:
    """One line per dataset with any problem; 1 where the problem was found."""
    rows = spark.createDataFrame(list(marks), "dataset string, problem string")
    return summarise_problems(rows)


def summarise_problems(marks: DataFrame) -> DataFrame:
    """Roll up (dataset, problem) marks: per problem the number of distinct marks."""
    return marks.groupBy("dataset").agg(*[
        F.count_distinct(F.when(F.col("problem") == p, F.col("problem"))).cast("int").alias(p)
        for p in PROBLEMS])


def profile(
    spark: SparkSession, datasets: Iterable[RawDataset], subject_identifier: str = KEY,
    parallelism: int = 4,
) -> ProfileReport:
    """Check and clean datasets, several at a time, then make feature names distinct.

    Per dataset one aggregate pass finds gaps, numbers, dates and symbols for all columns;
    repeated keys and repeated column names are looked at only in what they concern.
    """
    key = clean_name(subject_identifier)
    checked = in_threads(spark, lambda raw: _profile_one(raw, key), list(datasets), parallelism)
    report = ProfileReport(None, None, {})
    marks = [(c.name, problem) for c in checked for problem in c.problems]
    counts = [(c.name, *line) for c in checked for line in c.counts]
    names = {c.name: c.names for c in checked if c.clean is not None}
    for c in checked:
        report.evidence.update(c.evidence)
        if c.clean is not None:
            report.clean[c.name] = c.clean
            report.date_features[c.name] = c.dates
        if c.duplicate_rows is not None:
            report.duplicate_rows[c.name] = c.duplicate_rows
    hashed = spark.createDataFrame(
        counts,
        "dataset string, feature string, unique_name string, na_count bigint, have_data bigint")
    report.na_counts = mark_duplicated(hashed.select(
        "dataset", "feature", feature_hash(F.col("dataset"), F.col("unique_name")).alias(
            "data_feature_hash"), "na_count", "have_data"))
    report.problems = problem_table(spark, marks)
    report.losses = spark.createDataFrame(
        [(c.name, problem, n) for c in checked for problem, n in c.losses if n],
        "dataset string, problem string, rows bigint")
    _rename_across(spark, report, counts, names)
    return report


@dataclass
class _Checked:
    """What was found in one dataset."""

    name: str
    problems: list[str] = field(default_factory=list)
    counts: list[tuple] = field(default_factory=list)
    losses: list[tuple[str, int]] = field(default_factory=list)
    names: dict[str, str] = field(default_factory=dict)
    clean: DataFrame | None = None
    dates: list[str] = field(default_factory=list)
    duplicate_rows: DataFrame | None = None
    evidence: dict = field(default_factory=dict)


def _profile_one(raw: RawDataset, key: str) -> _Checked:
    result = _Checked(raw.name)
    bases = [clean_name(h) for h in raw.header]
    cells = raw.checked if raw.checked is not None else raw.frame.withColumn(MALFORMED, F.lit(False))
    if key not in bases:
        result.problems.append("subject_id_not_found")
        if raw.checked is not None:
            # Spark refuses to read the mark of a row alone.
            found = scan(cells, {"unlike": F.count_if(MALFORMED), "filled": F.count("c0")})
            result.losses.append((LOSSES[0], found["unlike"]))
        return result
    at = bases.index(key)
    rest = [i for i in range(len(bases)) if i != at]
    unique = dict(zip(rest, make_unique([KEY, *[bases[i] for i in rest]])[1:]))
    named = [F.col(f"c{at}").alias(KEY), *[F.col(f"c{i}").alias(unique[i]) for i in rest]]
    frame = raw.frame.select(*named).filter(F.col(KEY).isNotNull())
    features = list(unique.values())
    found = _scan_cells(cells.select(*named, MALFORMED), features)
    result.losses += zip(LOSSES, (found["unlike"], found["keyless"]))

    result.dates = [c for c in features if found["date", c]]
    if result.dates:
        result.problems.append("date_not_unix")
    if any(found["symbols", c] for c in features if c not in result.dates):
        result.problems.append("data_are_symbols")
    if has_repeats(frame, KEY):
        result.problems.append("subject_id_duplicated")
        result.duplicate_rows = number_repeats(get_dupes(frame, [KEY]), KEY, features)
    for i, c in unique.items():
        filled = found["filled", c]
        result.counts.append((bases[i], c, found["rows"] - filled, filled))

    renamed = {u: u for u in features}
    numeric = {c for c in features if found["numeric", c] and c not in result.dates}
    dropped = _resolve_copies(
        frame, {u: bases[i] for i, u in unique.items() if u not in result.dates},
        numeric, renamed, result)
    kept = [c for c in features if c not in dropped]
    result.names = {u: renamed[u] for u in kept}
    result.clean = frame.select(KEY, *[
        _typed(c, c in numeric, c in result.dates).alias(renamed[c]) for c in kept])
    return result


def _typed(column: str, numeric: bool, date: bool):
    cell = F.col(column)
    if date:
        return cell
    return as_number(cell) if numeric else F.when(
        cell.isin(*RETYPE_NULLS), None).otherwise(cell)


def _scan_cells(frame: DataFrame, features: list[str]) -> dict:
    """Counts over all rows; the features are looked at in rows with a subject."""
    has_key = F.col(KEY).isNotNull()
    measures = {"rows": F.count(KEY), "keyless": F.count_if(~has_key), "unlike": F.count_if(MALFORMED)}
    for c in features:
        cell = F.when(has_key, F.col(c))
        usable = F.when(~cell.isin(*RETYPE_NULLS), cell)
        measures["filled", c] = F.count(cell)
        measures["numeric", c] = F.bool_and(is_numeric_text(usable))
        measures["date", c] = F.bool_or(is_us_date(cell))
        measures["symbols", c] = F.bool_or(is_symbol_only(cell))
    return scan(frame, measures)


def _resolve_copies(frame, bases, numeric, renamed, result) -> set[str]:
    """Columns of one name: drop copies of the same data, rename different data."""
    copies: dict[str, list[str]] = {}
    for unique_name, base in bases.items():
        copies.setdefault(base, []).append(unique_name)
    copies = {b: cs for b, cs in copies.items() if len(cs) > 1}
    if not copies:
        return set()
    all_numeric = {b for b, cs in copies.items() if all(c in numeric for c in cs)}
    long = copies_to_long(frame, KEY, copies, all_numeric)
    # One line per duplicated feature, and one per surviving copy.
    verdicts = {r["feature"]: r["verdict"] for r in classify_duplicates(long).collect()}
    survivors = {r["copy"] for r in surviving_copies(long).collect()}
    dropped: set[str] = set()
    for base, columns in copies.items():
        kind = verdicts.get(base, "duplicated_column_names")
        folder = "duplicated_data" if kind == "duplicated_data" else "duplicated_colnames"
        result.evidence[folder, result.name, base] = duplicate_evidence(frame, KEY, columns)
        result.problems.append(kind)
        if kind == "duplicated_data":
            dropped.update(c for c in columns if c not in survivors)
            for place, column in enumerate(c for c in columns if c in survivors):
                renamed[column] = base if place == 0 else f"{base}_{place + 1}"
        else:
            for column in columns:
                renamed[column] = f"{base}_{_md5(f'{result.name}_{column}')}"
    return dropped


def _md5(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()


def _rename_across(spark, report, counts, names) -> None:
    """Distinct names over all datasets, applied before anything is written."""
    filled = {(d, u): h for d, _, u, _, h in counts}
    rows = [(d, final, filled[d, u]) for d, cols in names.items() for u, final in cols.items()]
    if not rows:
        return
    table = spark.createDataFrame(rows, "dataset string, feature string, have_data bigint")
    for r in rename_across_datasets(table).collect():
        if r["feature"] != r["new_feature_name"]:
            report.renames.setdefault(r["dataset"], {})[r["feature"]] = r["new_feature_name"]
    for dataset, mapping in report.renames.items():
        report.clean[dataset] = report.clean[dataset].withColumnsRenamed(mapping)

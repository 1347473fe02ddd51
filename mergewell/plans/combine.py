"""From clean datasets to one complete, non-redundant table for learning."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from mergewell.functions.naming import clean_name, make_unique
from mergewell.lineage import cut_lineage
from mergewell.operators.columns import count_values, string_columns
from mergewell.operators.completeness import complete_table
from mergewell.operators.correlation import (
    PAIRS, pearson_pairs, rank_columns, spearman_pairs, strong_pairs_report)
from mergewell.operators.encoding import (
    COLUMN_LIMIT, constant_columns, level_counts, near_empty_columns, one_hot)
from mergewell.operators.levels import (
    as_vector, entry_names, find_levels, informative, keep_uncorrelated, numbered, sizes_of)
from mergewell.operators.merge import find_repeats, merge_all, missing_keys, reattach
from mergewell.operators.redundancy import (
    choose_survivors, drop_redundant_numeric, drop_redundant_strings, feature_summary,
    group_correlated, resolve_label)
from mergewell.plans.profile import KEY, as_raw, profile


@dataclass
class CombineReport:
    merged_data_with_nas: DataFrame
    ml_table: DataFrame
    feature_summary: DataFrame
    groups: DataFrame
    correlated_features: DataFrame | None
    advisories: DataFrame
    label: str
    excluded: list[str] = field(default_factory=list)
    cutoff: float = 0.0
    levels: DataFrame | None = None  # (index, feature, level) of the vector column, if there is one


def exclude_unresolved(
    spark: SparkSession, datasets: dict[str, DataFrame], problems: DataFrame | None,
) -> tuple[dict[str, DataFrame], list[str]]:
    """Check the datasets an earlier profile flagged again; leave out those still bad."""
    if problems is None:
        return datasets, []
    flagged = {r["dataset"] for r in problems.select("dataset").collect()} & set(datasets)
    if not flagged:
        return datasets, []
    again = profile(spark, [as_raw(n, datasets[n]) for n in sorted(flagged)], KEY)
    bad = {r["dataset"] for r in again.problems.select("dataset").collect()}
    return {n: d for n, d in datasets.items() if clean_name(n) not in bad}, sorted(bad)


def size_advice(rows: int) -> list[tuple[str, str, float]]:
    if rows < 200:
        return [("very_few_samples", "overfitting is a major concern below 200 samples", rows)]
    if rows < 400:
        return [("few_samples", "between 200 and 400 samples is a small table", rows)]
    return []


def class_counts(labelled: DataFrame, label: str) -> DataFrame:
    """One line per class of a text label; none for a number."""
    text = labelled if labelled.schema[label].dataType.simpleString() == "string" else labelled.limit(0)
    return text.groupBy(F.col(label).cast("string").alias("message")).agg(
        F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("class_count").alias("code"), "message", "value")


def combine(
    spark: SparkSession, datasets: dict[str, DataFrame], label: str = "label",
    cor_level: float = 0.99, choose: dict[str, str] | None = None,
    preserve_samples: bool = False, problems: DataFrame | None = None,
    on_repeat: str = "exclude", near_empty_rows: int | None = 1,
) -> CombineReport:
    """Merge on subject_id, drop redundant, sparse and correlated features, encode text.

    Levels of a text become columns; those of texts with more than COLUMN_LIMIT levels become
    entries of one sparse vector column, named in `levels`, after the same filters.

    `choose` names another survivor for a group of correlated features, by the group's
    first feature.  Datasets with repeated keys are left out, or refused with
    on_repeat="error", because a merge would multiply their rows.
    """
    label = clean_name(label)
    datasets, excluded = exclude_unresolved(spark, datasets, problems)
    repeated = find_repeats(datasets, KEY) if datasets else []
    if repeated and on_repeat == "error":
        raise ValueError(f"repeated subjects in {repeated}")
    datasets = {n: d for n, d in datasets.items() if n not in repeated}
    excluded += repeated
    if not datasets:
        raise ValueError("no dataset left to merge")

    # Every table of the report starts from the merge: it is done once, whatever is written.
    merged = cut_lineage(merge_all(list(datasets.values()), KEY))
    keyless = missing_keys(datasets, KEY)
    return _reduce(spark, merged, label, cor_level, choose, preserve_samples, excluded,
                   near_empty_rows, keyless)


def _reduce(spark, merged, label, cor_level, choose, preserve_samples, excluded, near_empty_rows,
            keyless):
    rows, _ = count_values(merged, [])
    advice = size_advice(rows)
    advice += [("subject_id_missing", f"rows of {name} without a subject are left out", n) for name, n in keyless]
    if cor_level < 0.99:
        advice.append(("low_cor_level", "a global filter this strict can leak information", cor_level))

    deduped, _ = drop_redundant_numeric(merged, KEY, label)
    deduped, _ = drop_redundant_strings(deduped, KEY, label)
    deduped, label, _ = resolve_label(deduped, label)
    if label not in deduped.columns:
        raise ValueError(f"cannot find label {label}")

    labelled = deduped.filter(F.col(label).isNotNull())
    complete, kept, cutoff = complete_table(labelled, KEY, preserve_samples)
    if label not in kept:
        complete = reattach(complete, labelled.select(KEY, label), KEY)

    texts = string_columns(complete, (KEY, label))
    # Texts with more levels than may become columns share one sparse vector.
    counts = level_counts(complete, texts)
    wide = [c for c in texts if counts[c] > COLUMN_LIMIT]
    if wide:
        complete = cut_lineage(complete)
    # Written once: what follows looks at these columns again and again, and the optimiser's time
    # grows without measure with the number of expressions on one column.
    encoded = cut_lineage(one_hot(complete, [c for c in texts if c not in wide]))
    predictors = [c for c in encoded.columns if c not in (KEY, label, *wide)]
    encoded = encoded.drop(*constant_columns(encoded, predictors))
    predictors = [c for c in encoded.columns if c not in (KEY, label, *wide)]
    if near_empty_rows is not None:
        encoded = encoded.drop(*near_empty_columns(encoded, predictors, near_empty_rows))
        predictors = [c for c in encoded.columns if c not in (KEY, label, *wide)]

    entries, sizes = None, {}
    if wide:
        ranks = cut_lineage(rank_columns(encoded, predictors, KEY) if predictors else encoded.select(KEY))
        pairs = pearson_pairs(ranks, predictors)
        levels, links = keep_uncorrelated(
            informative(find_levels(complete, KEY, wide), near_empty_rows), ranks, predictors, cor_level,
            pairs.filter(F.abs("corr") >= cor_level))
        # Columns that only levels link are linked as well.
        pairs = pairs.unionByName(spark.createDataFrame([(a, b, 1.0) for a, b in links], PAIRS))
        entries = numbered(levels)
        sizes = sizes_of(entries)
    else:
        pairs = spearman_pairs(encoded, predictors)
    groups = choose_survivors(group_correlated(pairs, predictors, cor_level), choose)
    # One line per column of the table.
    decided = {r["survivor"]: list(r["members"]) + [r["keep"]] for r in groups.collect()}
    survivors = [c for c in predictors if c in decided]
    linked = [c for members in decided.values() if len(members) > 1 for c in members]
    vector = make_unique([*survivors, label, KEY, "levels"])[-1] if sizes else None
    final = survivors + [label] + [c for c in wide if sizes.get(c)]
    report = strong_pairs_report(encoded, linked, cor_level) if linked else None

    def names(values):
        return spark.createDataFrame([(v,) for v in values], "features string")

    summary = feature_summary(
        names([c for c in deduped.columns if c != KEY]), names([c for c in kept]),
        names(linked), names(final))
    ml_table = encoded.select(KEY, *survivors, label, *wide)
    if wide:
        ml_table = as_vector(ml_table, wide, entries, sizes, vector)
        ml_table = ml_table.select(KEY, *survivors, *([vector] if sizes else []), label)
    return CombineReport(
        merged_data_with_nas=deduped, ml_table=ml_table,
        feature_summary=summary, groups=groups, correlated_features=report,
        advisories=spark.createDataFrame(
            [(c, m, float(v)) for c, m, v in advice], "code string, message string, value double").unionByName(
            class_counts(labelled, label)),
        label=label, excluded=excluded, cutoff=cutoff,
        levels=entry_names(wide, entries, sizes) if sizes else None)

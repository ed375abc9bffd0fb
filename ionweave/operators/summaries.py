"""Counts, statistics, histograms and digests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ionweave.functions.numeric import UNIT_SCALE, exact_parts, exact_total
from ionweave.functions.text import (
    PHOSPHO_PATTERN,
    cluster_id,
    comma_members,
    contains_pattern,
    protein_group,
    strip_modifications,
)


def n_distinct(column: str) -> Column:
    """Distinct values, null counted as one value."""
    return F.count_distinct(F.col(column)) + F.max(F.col(column).isNull().cast("int"))


def edge_counts(edges: DataFrame) -> DataFrame:
    """Distinct MS1 ids, distinct MS2 ids and rows of an edge table, as one row."""
    zero = F.lit(0).cast("bigint")
    return edges.agg(
        F.coalesce(n_distinct("MS1_ClusterID"), zero).alias("MS1_ClusterID"),
        F.coalesce(n_distinct("MS2_ClusterID"), zero).alias("MS2_ClusterID"),
        F.count(F.lit(1)).alias("edges"),
    )


def table_size(df: DataFrame) -> DataFrame:
    """Row count, as one row."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def distinct_counts(df: DataFrame, metrics: Mapping[str, Sequence[str]]) -> DataFrame:
    """Distinct values of each column group, nulls counted as values, as one row."""
    return df.agg(*[F.count_distinct(F.struct(*columns)).alias(name) for name, columns in metrics.items()])


PSM_METRICS = (
    "proteins_in_protein_groups",
    "protein_groups",
    "peptide_sequences_stripped_of_mods",
    "peptides_with_mods",
    "charged_peptides_with_mods",
    "phosphopeptides",
    "MS1_ClusterID",
)


def psm_stats(psms: DataFrame) -> DataFrame:
    """Seven distinct counts over identified peptides, as one row.

    Protein groups count as written, so the order of members matters here, unlike in
    :func:`protein_group_stats`.  One scan and one shuffle find the distinct values of all
    sets; lists are then taken apart and modifications stripped once per distinct text.
    """
    proteins, peptide = F.col("protein_list"), F.col("peptide")
    columns = psms.select(
        proteins, peptide, "charge", cluster_id(F.col("spectrum_id")).alias("MS1_ClusterID")
    )
    sets = {
        "protein_groups": ["protein_list"],
        "peptides_with_mods": ["peptide"],
        "charged_peptides_with_mods": ["peptide", "charge"],
        "MS1_ClusterID": ["MS1_ClusterID"],
    }
    names = columns.columns
    # grouping_id has a bit for each column that is not in the set, the first column highest
    ids = {
        metric: sum(1 << i for i, c in enumerate(reversed(names)) if c not in members)
        for metric, members in sets.items()
    }
    seen = columns.groupingSets(list(sets.values()), *names).agg(F.grouping_id().alias("set"))

    def entry(metric: str, value: Column) -> Column:
        return F.struct(F.lit(metric).alias("metric"), value.alias("value"))

    counted = F.lit(None).cast("string")  # counted by rows, so the value itself is not needed
    members = F.transform(comma_members(proteins), lambda v: entry("proteins_in_protein_groups", v))
    per_peptide = F.filter(
        F.array(
            entry("peptides_with_mods", counted),
            entry("peptide_sequences_stripped_of_mods", strip_modifications(peptide)),
            entry("phosphopeptides", counted),
        ),
        lambda e: (e["metric"] != "phosphopeptides") | contains_pattern(peptide, PHOSPHO_PATTERN),
    )
    one_group = F.array(entry("protein_groups", counted))
    entries = (
        F.when(F.col("set") == ids["protein_groups"], F.concat(one_group, F.coalesce(members, F.slice(one_group, 1, 0))))
        .when(F.col("set") == ids["peptides_with_mods"], per_peptide)
        .when(
            F.col("set") == ids["charged_peptides_with_mods"],
            F.array(entry("charged_peptides_with_mods", counted)),
        )
        .otherwise(F.array(entry("MS1_ClusterID", counted)))
    )
    values = seen.select(F.inline(entries)).groupBy("metric", "value").agg(F.count(F.lit(1)).alias("rows"))
    by_value = ("proteins_in_protein_groups", "peptide_sequences_stripped_of_mods")
    return values.agg(
        *[
            F.coalesce(
                F.sum(F.when(F.col("metric") == m, F.lit(1) if m in by_value else F.col("rows"))), F.lit(0)
            ).cast("bigint").alias(m)
            for m in PSM_METRICS
        ]
    )


def protein_group_stats(psms: DataFrame, column: str = "protein_list") -> DataFrame:
    """Distinct protein groups regardless of member order, and their distinct members.

    ``groups_are_unique`` tells whether every row has a group of its own.
    """
    members = protein_group(F.col(column))
    per_group = (
        psms.select(members.alias("members")).groupBy("members").agg(F.count(F.lit(1)).alias("k"))
    )
    # members of the distinct groups only; the count of rows rides along on the first member
    entries = per_group.select(F.posexplode_outer("members").alias("at", "member"), "k")
    per_member = entries.groupBy("member").agg(
        F.count_if(F.coalesce("at", F.lit(0)) == 0).alias("groups"),
        F.sum(F.when(F.coalesce("at", F.lit(0)) == 0, F.col("k"))).alias("psms"),
    )
    return per_member.agg(
        F.count(F.lit(1)).alias("proteins_in_protein_groups"),
        F.coalesce(F.sum("groups"), F.lit(0)).alias("protein_groups"),
        (F.coalesce(F.sum("groups"), F.lit(0)) == F.coalesce(F.sum("psms"), F.lit(0))).alias("groups_are_unique"),
    )


def multiplicity(df: DataFrame, keys: Sequence[str], more_than: int = 1) -> DataFrame:
    """Keys seen more than ``more_than`` times, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > more_than)


def cluster_stats(
    points: DataFrame,
    axes: Mapping[str, str],
    weight: str = "intensity",
    key: str = "ClusterID",
) -> DataFrame:
    """Size, total weight and, per axis, weighted mean, minimum and maximum of each cluster.

    ``axes`` maps a point column to the name used in the output (``<name>_wmean``, ``_min``,
    ``_max``).  Values are added up exactly, map side, per cluster and scale, and then over the few scales of a
    cluster: results do not depend on the order of rows, and digits are not cut.  Means with
    weights of at least 0 lie between minimum and maximum.
    """
    w = F.col(weight).cast("double")
    amounts = [w, *[F.col(c).cast("double") * w for c in axes]]
    columns = [F.col(key), w.alias("_w"), *[F.col(c).alias(f"_x{i}") for i, c in enumerate(axes, 1)]]
    for i, amount in enumerate(amounts):
        scale, whole, odd = exact_parts(amount)
        columns += [scale.alias(f"_scale{i}"), whole.cast("decimal(28,0)").alias(f"_whole{i}"), odd.alias(f"_odd{i}")]
    ends = range(1, len(amounts))
    by_scale = points.select(*columns).groupBy(key, *[f"_scale{i}" for i in range(len(amounts))]).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("_w").alias("_w"),
        *[F.sum(f"_{part}{i}").alias(f"_{part}{i}") for part in ("whole", "odd") for i in range(len(amounts))],
        *[F.min(f"_x{i}").alias(f"_lo{i}") for i in ends],
        *[F.max(f"_x{i}").alias(f"_hi{i}") for i in ends],
    )
    totals = by_scale.groupBy(key).agg(
        F.sum("_n").alias("_n"),
        F.min("_w").alias("_w"),
        *[
            exact_total(F.col(f"_scale{i}"), F.col(f"_whole{i}"), F.col(f"_odd{i}")).alias(f"_total{i}")
            for i in range(len(amounts))
        ],
        *[F.min(f"_lo{i}").alias(f"_lo{i}") for i in ends],
        *[F.max(f"_hi{i}").alias(f"_hi{i}") for i in ends],
    )
    out = [F.col(key), F.col("_n").alias("size"), F.col("_total0").alias(f"{weight}_sum")]
    for i, name in enumerate(axes.values(), 1):
        lo, hi, mean = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_total{i}") / F.col("_total0")
        inside = F.greatest(F.least(mean, hi.cast("double")), lo.cast("double"))
        mean = F.when((F.col("_w") >= 0) & ~F.isnan(mean), inside).otherwise(mean)
        out += [mean.alias(f"{name}_wmean"), lo.alias(f"{name}_min"), hi.alias(f"{name}_max")]
    return totals.select(*out)


def summarize_table(df: DataFrame) -> DataFrame:
    """One row per numeric column: n, n_null, n_distinct, min, max and mean.

    Values are counted by (column, value) first: equal values meet in the map tasks, and
    all columns share one scan.  Means come from exact sums, in any order of rows.  Minimum and maximum are
    doubles, as one column serves all types.
    """
    whole = [f.name for f in df.schema if isinstance(f.dataType, T.IntegralType)]
    broken = [f.name for f in df.schema if isinstance(f.dataType, (T.FractionalType,))]
    if not whole + broken:
        raise ValueError("the table has no numeric column")
    names = whole + broken
    entries = [
        F.struct(
            F.lit(i).alias("at"),
            (F.col(f"`{c}`") if c in whole else F.lit(None)).cast("bigint").alias("whole"),
            (F.col(f"`{c}`") if c in broken else F.lit(None)).cast("double").alias("broken"),
        )
        for i, c in enumerate(names)
    ]
    values = df.select(F.inline(F.array(*entries)))
    counted = values.groupBy("at", "whole", "broken").agg(F.count(F.lit(1)).alias("k"))
    name = F.element_at(F.array(*[F.lit(c) for c in names]), F.col("at") + 1)
    scale, mantissa, odd = exact_parts(F.col("broken"))
    amount = F.coalesce("whole", mantissa).cast("decimal(19,0)") * F.col("k").cast("decimal(18,0)")
    by_scale = (
        counted.select(
            "at", "k", F.coalesce(F.col("broken"), F.col("whole").cast("double")).alias("value"),
            F.when(F.col("whole").isNotNull(), UNIT_SCALE).otherwise(scale).alias("scale"),
            amount.alias("amount"), odd.alias("odd"),
        )
        .groupBy("at", "scale")
        .agg(
            F.sum("k").alias("n"),
            F.sum(F.when(F.col("value").isNotNull(), F.col("k")).otherwise(0)).alias("present"),
            F.count("value").alias("n_distinct"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            F.sum("amount").alias("amount"),
            F.sum("odd").alias("odd"),
        )
    )
    total = exact_total(F.col("scale"), F.col("amount"), F.col("odd"))
    return by_scale.groupBy("at").agg(
        F.first(name).alias("column"),
        F.sum("n").alias("n"),
        (F.sum("n") - F.sum("present")).alias("n_null"),
        F.sum("n_distinct").alias("n_distinct"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        (total / F.nullif(F.sum("present"), F.lit(0))).alias("mean"),
    ).drop("at")


def bin_index(column: str, origin: float, width: float) -> Column:
    """Number of the fixed-width bin a value falls into."""
    return F.floor((F.col(column) - F.lit(float(origin))) / F.lit(float(width)))


def marginal_histograms(df: DataFrame, bins: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Histogram of each column in ``{column: (origin, width)}``: axis, bin and n.

    Only bins with rows appear.  All columns share one scan and one shuffle of counts.
    """
    entries = [
        F.struct(F.lit(c).alias("axis"), bin_index(c, origin, width).alias("bin"))
        for c, (origin, width) in bins.items()
    ]
    return (
        df.select(F.inline(F.array(*entries)))
        .where(F.col("bin").isNotNull())
        .groupBy("axis", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def histogram_2d(
    df: DataFrame,
    x: tuple[str, float, float],
    y: tuple[str, float, float],
    weight: str | None = None,
) -> DataFrame:
    """Rows and total weight per (bin_x, bin_y); axes are (column, origin, width)."""
    counts = [F.count(F.lit(1)).alias("n")]
    if weight:
        counts.append(F.sum(weight).alias("weight"))
    binned = df.withColumn("bin_x", bin_index(*x)).withColumn("bin_y", bin_index(*y))
    return binned.where("bin_x IS NOT NULL AND bin_y IS NOT NULL").groupBy("bin_x", "bin_y").agg(*counts)


def search_stats(
    precursors: DataFrame,
    fragments: DataFrame | None = None,
    edges: DataFrame | None = None,
    ordinal: str = "fragment_ordinals",
    kind: str = "fragment_type",
) -> DataFrame:
    """Statistics of a search, in long form: one row per (metric, n).

    Of ``fragments`` (with MS1_ClusterID): distinct (MS1, ordinal) per type y and b.  Of
    ``edges`` (with n_fragments, as mapped back): edges, edges with several
    fragments, and the precursors of those.
    """
    wide = psm_stats(precursors)
    parts = [(wide, wide.columns)]
    if fragments is not None:
        types = ("y", "b")
        kinds = fragments.where(F.col(kind).isin(*types)).select("MS1_ClusterID", ordinal, kind).distinct()
        typed = kinds.agg(*[F.count_if(F.col(kind) == t).alias(f"unique_{t}_fragments") for t in types])
        parts.append((typed, typed.columns))
    if edges is not None:
        several = F.col("n_fragments") > 1
        counts = edges.agg(
            F.count(F.lit(1)).alias("edges"),
            F.count_if(several).alias("edges_with_multiply_annotated_fragments"),
            F.count_distinct(F.when(several, F.col("MS1_ClusterID"))).alias(
                "precursors_with_multiply_annotated_fragments"
            ),
        )
        parts.append((counts, counts.columns))
    long = [
        df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("bigint").alias("n")) for c in names])))
        for df, names in parts
    ]
    out = long[0]
    for more in long[1:]:
        out = out.unionByName(more)
    return out


def content_digests(df: DataFrame, name: str, content: str) -> DataFrame:
    """SHA-256 of each row's content, as lower-case hex."""
    return df.select(name, F.sha2(F.col(content).cast("binary"), 256).alias("sha256"))


def sequence_stats(records: DataFrame, decoy_prefix: str = "rev_") -> DataFrame:
    """Summary of a sequence table (header, sequence), as one row."""
    length = F.length("sequence")
    accession = F.element_at(F.split("header", r"\s+", 2), 1)
    total = F.sum(length)
    return records.agg(
        F.count(F.lit(1)).alias("n_sequences"),
        F.count_distinct(accession).alias("n_accessions"),
        F.count_if(F.startswith("header", F.lit(decoy_prefix))).alias("n_decoys"),
        total.alias("n_residues"),
        F.min(length).alias("min_length"),
        F.max(length).alias("max_length"),
        (total.cast("double") / F.count(F.lit(1))).alias("mean_length"),
    )

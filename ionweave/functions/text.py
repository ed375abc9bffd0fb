"""String columns: cluster ids, peptides, protein lists and modification tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The formats of the identification tables.
MODIFICATION_PATTERN = r"\[.*?\]"
PHOSPHO_PATTERN = "79.9663"
DECOY_PATTERN = "%rev_%"
LONG_TAG = "UNIMOD"
SHORT_TAG = "U"


def cluster_id(header: Column, on_error: str = "raise") -> Column:
    """Second dot-separated field of a spectrum header, as a bigint.

    ``on_error="raise"`` fails the job on a header without such a field;
    ``"null"`` gives null instead.
    """
    field = F.split_part(header, F.lit("."), F.lit(2))
    if on_error == "raise":
        return field.cast("bigint")
    if on_error == "null":
        return field.try_cast("bigint")
    raise ValueError(f"on_error is 'raise' or 'null', not {on_error!r}")


def strip_modifications(peptide: Column) -> Column:
    """Drop every bracketed part of a peptide."""
    return F.regexp_replace(peptide, MODIFICATION_PATTERN, "")


def comma_members(protein_list: Column) -> Column:
    """Members of a comma list; empty members stay."""
    return F.split(protein_list, ",")


def protein_group(literal: Column) -> Column:
    """Sorted members of a list literal such as ``['b', 'a']``."""
    body = F.substring(literal, F.lit(2), F.length(literal) - 2)
    return F.array_sort(F.split(F.replace(body, F.lit("'"), F.lit("")), ", "))


def contains_pattern(text: Column, pattern: str) -> Column:
    """Regex containment; null text is false."""
    return F.coalesce(text.rlike(pattern), F.lit(False))


def modification_tag(mod_id: Column, prefix: str = LONG_TAG) -> Column:
    """``[UNIMOD:id]``, or ``[U:id]`` with ``prefix=SHORT_TAG``."""
    return F.concat(F.lit(f"[{prefix}:"), mod_id.cast("string"), F.lit("]"))

"""Filters and projections."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ionweave.functions.numeric import dyadic
from ionweave.functions.text import DECOY_PATTERN, SHORT_TAG, modification_tag
from ionweave.operators.ordering import with_batch_id, with_row_index
from ionweave.staging import new_path, stage

# Defaults of the confidence filter and the three extent axes.
Q_COLUMN = "mokapot q-value"
Q_LIMIT = 0.01
EXTENT_AXES = ("frame", "retention_time", "inv_ion_mobility")

EDGE_KEY = ("MS1_ClusterID", "MS2_ClusterID")
BATCHES_PER_JOB = 16  # batches that one job filters side by side


def confident_targets(
    psms: DataFrame,
    q_column: str = Q_COLUMN,
    q_limit: float = Q_LIMIT,
    protein_column: str = "protein_list",
    decoy_pattern: str = DECOY_PATTERN,
) -> DataFrame:
    """Matches below the error limit that name no decoy.

    ``decoy_pattern`` is a LIKE pattern (``_`` stands for any character).  A null in either
    column drops the row.
    """
    q = F.col(f"`{q_column}`")
    return psms.where((q < q_limit) & ~F.col(protein_column).like(decoy_pattern))


def query_tables(sql: str, **tables: DataFrame) -> DataFrame:
    """Run SQL over DataFrames, named as ``{name}`` in the text.

    ``'{name}'`` means the same: quotes are needed where a name stands for a file path.
    """
    for name in tables:
        sql = sql.replace(f"'{{{name}}}'", f"{{{name}}}")
    return next(iter(tables.values())).sparkSession.sql(sql, **tables)


def filter_edges(
    edges: DataFrame,
    predicate: str | Column,
    order_by: Sequence[str] = EDGE_KEY,
    index: str = "original_idx",
) -> DataFrame:
    """Keep edges by a condition on single rows; adds the index each edge had before.

    A condition on single rows gives the same for every batch size.  ``order_by`` must
    be a key; two edges with the same key fail the job.
    """
    return with_row_index(edges, order_by, name=index).where(predicate)


def filter_edges_batched(
    edges: DataFrame,
    sql: str,
    batch_size: int,
    order_by: Sequence[str] = EDGE_KEY,
    index: str = "original_idx",
) -> DataFrame:
    """Filter edges by SQL that is run on each batch of ``batch_size`` neighbours.

    ``{local_edges}`` in the SQL is one batch, with its index and a ``batch_id``.  Runs at once.  SQL that takes each edge by
    itself but for subqueries over the batch, or windows by ``batch_id``, is one query over all batches (:func:`_batches_at_once`).
    For other SQL the indexed edges are stored in folders by batch, and a job filters ``BATCHES_PER_JOB`` of them and adds its
    rows to the result.  Raises if the result lost the index or holds an edge twice.
    """
    indexed = with_batch_id(with_row_index(edges, order_by, name=index), batch_size, index)
    spark, path = edges.sparkSession, new_path(edges.sparkSession, "filtered")

    def checked(part: DataFrame) -> DataFrame:
        if index not in part.columns:
            raise ValueError(f"the filter dropped {index}")
        return part

    stored = stage(indexed, "indexed")
    at_once = _batches_at_once(sql, stored)
    if at_once is not None:
        checked(at_once).write.parquet(path)
        schema = at_once.schema
    else:
        stored = stage(stored, "batches", by=["batch_id"])
        last = stored.agg(F.max("batch_id")).first()[0] or 0
        for start in range(0, last + 1, BATCHES_PER_JOB):
            numbers = range(start, min(start + BATCHES_PER_JOB, last + 1))
            parts = [checked(query_tables(sql, local_edges=stored.where(F.col("batch_id") == i))) for i in numbers]
            schema = parts[0].schema
            reduce(DataFrame.union, parts).write.mode("append").parquet(path)
    out = spark.read.schema(schema).parquet(path)
    twice = out.groupBy(index).count().where("count > 1").first()
    if twice:
        raise ValueError(f"the filter repeats edge {twice[index]}")
    return out


_ROW_BY_ROW = ("Project", "Filter", "SubqueryAlias", "Window", "View")  # nodes that may stand over all batches at once
_OWN_BATCH = "_batch_of_subquery"


def _batches_at_once(sql: str, batches: DataFrame) -> DataFrame | None:
    """The SQL of a batch as one query over all of ``batches``; None if that is not sure to give the same rows.

    The outer query runs over the whole table.  In a subquery ``{local_edges}`` becomes the edges with the ``batch_id`` of the
    outer row, which Spark turns into a join by batch.  The analyzed plan must show that the outer query takes row by row, with
    windows by ``batch_id`` only, and that every subquery reads nothing but the batch of its row.
    """
    parts = re.split(r"(?:'\{local_edges\}'|\{local_edges\})", sql)
    if len(parts) < 2 or re.search(r"--|/\*|\{(?!local_edges\})", sql) or _OWN_BATCH in sql:
        return None
    columns = ", ".join(f"`{c}`" for c in batches.columns[:-1])
    own = f"(SELECT {columns}, {_OWN_BATCH} AS batch_id FROM {{other_edges}} WHERE {_OWN_BATCH} = batch_id)"
    text, outer = parts[0], 0
    for part in parts[1:]:
        nested = _in_subquery(text)
        outer += not nested
        text += (own if nested else "{local_edges}") + part
    if outer != 1:
        return None
    tables = {"local_edges": batches}
    if "{other_edges}" in text:
        tables["other_edges"] = batches.withColumnRenamed("batch_id", _OWN_BATCH)
    try:
        found = query_tables(text, **tables)
    except (AnalysisException, ParseException):
        return None
    plan, leaf = found._jdf.queryExecution().analyzed(), batches._jdf.queryExecution().analyzed()
    return found if _row_by_row(plan, leaf) else None


def _in_subquery(text: str) -> bool:
    """Does a subquery within an expression, so none of a FROM clause, stand open at the end of ``text``?"""
    text = re.sub(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`", "x", text)
    opened: list[bool] = []
    for token in re.finditer(r"(?:(\w+)\s*)?\((?=\s*(\w*))|\)", text):
        if token.group() == ")":
            opened = opened[:-1]
        else:
            query = (token[2] or "").upper() in ("SELECT", "WITH", "FROM", "VALUES")
            opened.append(query and (token[1] or "").upper() not in ("FROM", "JOIN"))
    return any(opened)


def _row_by_row(plan, leaf) -> bool:
    """Does an analyzed plan take the rows of ``leaf`` one by one, and its subqueries only the rows of the same batch?"""
    def nodes(of) -> list:
        return [of.apply(i) for i in range(of.size())]

    def batch(of) -> int | None:
        ids = [x.exprId().id() for x in nodes(of.output()) if x.name() == "batch_id"]
        return ids[0] if len(ids) == 1 else None

    chain = [plan]
    while not chain[-1].sameResult(leaf):
        below = nodes(chain[-1].children())
        if chain[-1].nodeName() not in _ROW_BY_ROW or len(below) != 1:
            return False
        chain.append(below[0])
    own = batch(chain[-1])
    for node in chain[:-1]:
        if not node.deterministic():
            return False
        if node.nodeName() == "Window" and own not in [x.exprId().id() for x in nodes(node.partitionSpec()) if x.nodeName() == "AttributeReference"]:
            return False
        for query in nodes(node.subqueries()):
            stack, filters, reads = [query], 0, 0
            while stack:
                x = stack.pop()
                if x.nodeName() == "Filter":
                    filters += bool(re.fullmatch(rf"\({_OWN_BATCH}#\d+L? = outer\(batch_id#{own}L?\)\)", x.condition().toString()))
                below = nodes(x.children())
                if not below:
                    reads += 1
                if nodes(x.subqueries()) or x.nodeName() in ("WithCTE", "CTERelationRef"):
                    return False
                stack += below
            if not reads or reads != filters:
                return False
    return True


def split_classes(edges: DataFrame, label: str = "Y") -> tuple[DataFrame, DataFrame]:
    """Negative and positive edges."""
    return edges.where(F.col(label) == 0), edges.where(F.col(label) == 1)


def require_balanced(edges: DataFrame, label: str = "Y") -> int:
    """Rows per class; raises unless classes 0 and 1 are both there and equal in size."""
    sizes = edges.agg(
        F.count_if(F.col(label) == 0).alias("negative"), F.count_if(F.col(label) == 1).alias("positive")
    ).first()
    if sizes["negative"] != sizes["positive"] or not sizes["negative"]:
        raise ValueError(f"classes differ in size or are empty: {sizes.asDict()}")
    return sizes["negative"]


def typed_columns_only(df: DataFrame) -> DataFrame:
    """Drop text, binary and nested columns: keep numbers, booleans, dates and times."""
    kept = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return df.select(*[f.name for f in df.schema if isinstance(f.dataType, kept)])


def with_extents(stats: DataFrame, axes: Sequence[str] = EXTENT_AXES) -> DataFrame:
    """Put ``<axis>_extent`` = max - min in front of the other columns."""
    extents = [(F.col(f"{a}_max") - F.col(f"{a}_min")).alias(f"{a}_extent") for a in axes]
    return stats.select(*extents, "*")


def aligned_features(stats: DataFrame, names: dict[str, str], key: str = "ClusterID") -> DataFrame:
    """The key and renamed columns (``{source: name}``), so that two tables line up."""
    return stats.select(key, *[F.col(source).alias(name) for source, name in names.items()])


def with_modification_columns(
    modifications: DataFrame, id_column: str = "id", mass_column: str = "monoisotopic_mass"
) -> DataFrame:
    """Add ``tag``, ``short_tag`` and the mass on the grid that tools compute with."""
    mod_id = F.col(id_column)
    return modifications.select(
        "*",
        modification_tag(mod_id).alias("tag"),
        modification_tag(mod_id, SHORT_TAG).alias("short_tag"),
        dyadic(F.col(mass_column)).alias("machine_monoisotopic_mass"),
    )


def in_order(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Global sort, nulls last."""
    return df.orderBy(*[F.asc_nulls_last(k) for k in keys])


def stacked(*tables: DataFrame) -> DataFrame:
    """All rows of all tables, columns matched by name."""
    first, *rest = tables
    for table in rest:
        first = first.unionByName(table)
    return first


def preview(df: DataFrame, n: int = 2) -> DataFrame:
    """The first rows of a sorted table, or any ``n`` rows of an unsorted one."""
    return df.limit(n)

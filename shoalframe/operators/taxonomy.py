"""Taxonomy: translation tables, descriptions from scores, rules, label updates.

A description is an anchor path (array of names from the root) and a set of qualifiers, each possibly negated, here an array of
strings in which "!" leads a negated one. A query matches a description if its anchor is on the description's path
and all its qualifiers are there; an update adds qualifiers (those they negate go) or a deeper anchor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_depth(table: DataFrame) -> DataFrame:
    """Lineages "a>b>c" split, with their depth."""
    return table.withColumn("path", F.split("lineage", ">")).withColumn("depth", F.size(F.split("lineage", ">")).cast("long"))


def without_wildcards(table: DataFrame, aliases: str = "aliases") -> DataFrame:
    return table.filter(~F.exists(F.col(aliases), lambda a: a.contains("*")))


def shallowest(table: DataFrame, key: str = "description", ordinal: str = "ordinal") -> DataFrame:
    """Of each description the shallowest lineage; of equal depths the first in the file."""
    w = Window.partitionBy(key).orderBy("depth", ordinal)
    return table.withColumn("_k", F.row_number().over(w)).filter("_k = 1").drop("_k")


def translation(table: DataFrame, parsed: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Forward (display_name to description) and backward (description to display_name) tables of a lineage table
    with ordinal, lineage, display_name, description and, optionally, aliases; rows that `parsed` is false for are left out."""
    t = with_depth(table if parsed is None else table.filter(parsed)).filter("description is not null")
    forward = t.select("display_name", "description")
    backward = shallowest(without_wildcards(t) if "aliases" in t.columns else t)
    return forward, backward.select("description", "display_name", "lineage", "depth")


def describe(scores: Column, names: list[str], threshold: float = 0.9, relative: float = 0.0) -> Column:
    """Names scored over the threshold, and "!"-led ones scored under 1 - threshold. With a relative margin, a positive
    name must also lead the second-best score by more than the margin."""
    second = F.sort_array(scores, asc=False)[1]

    def one(i: int, name: str) -> Column:
        p = scores[i]
        yes = p > threshold
        if relative > 0:
            yes = yes & (p > F.coalesce(second, F.lit(0.0)) + relative)
        return F.when(yes, F.lit(name)).when(p < 1 - threshold, F.lit("!" + name))

    return F.filter(F.array(*[one(i, n) for i, n in enumerate(names)]), lambda x: x.isNotNull())


def exclude_unpredicted(description: Column, parents: dict[str, str | None]) -> Column:
    """Names in `parents` (nodes that aren't to be predicted) replaced by their parents, those without one dropped."""
    if not parents:
        return description
    table = F.create_map(*[F.lit(x) for k, v in parents.items() for x in (k, v or "")])
    out = description
    for _ in parents:  # a parent may itself be left out
        out = F.filter(F.transform(out, lambda q: F.coalesce(F.try_element_at(table, q), q)), lambda q: q != "")
    return F.array_distinct(out)


def matches(description: Column, query: list[str]) -> Column:
    return F.size(F.array_except(F.array(*[F.lit(q) for q in query]).cast("array<string>"), description)) == 0


def update(description: Column, changes: list[str]) -> Column:
    """The description with the changes; what they contradict goes."""
    opposite = [c[1:] if c.startswith("!") else "!" + c for c in changes]
    return F.array_union(F.array_except(description, F.array(*map(F.lit, opposite))), F.array(*map(F.lit, changes)))


def parse_rules(rules: dict[str, str]) -> list[tuple[list[str], list[str]]]:
    """Ordered "a b !c: d" rules as (query, changes)."""
    return [(q.split(), u.split()) for q, u in rules.items()]


def apply_rules(table: DataFrame, column: str, rules: list[tuple[list[str], list[str]]], only: Column | None = None) -> DataFrame:
    """The rules in order, each on the result of those before; rows that `only` is false for stay as they are."""
    for query, changes in rules:
        hit = matches(F.col(column), query)
        if only is not None:
            hit = hit & F.coalesce(only, F.lit(False))
        table = table.withColumn(column, F.when(hit, update(F.col(column), changes)).otherwise(F.col(column)))
    return table


def positives(description: Column) -> Column:
    return F.filter(description, lambda q: ~q.startswith("!"))


def compatible(table: DataFrame, previous: str, validated: Column, query: list[str]) -> DataFrame:
    """Validated rows whose previous description misses the query are dropped; others stay."""
    return table.filter(~F.coalesce(validated, F.lit(False)) | matches(F.coalesce(F.col(previous), F.array().cast("array<string>")), query))


def readd(description: Column, previous: Column) -> Column:
    return F.array_union(description, F.coalesce(previous, F.array().cast("array<string>")))


def update_labels(table: DataFrame, new: str, old: str = "object_annotation_category", status: str = "object_annotation_status", skip_unchanged: bool = True) -> DataFrame:
    """A changed category is taken over with status `predicted`; unchanged rows (also those without a new one) go, or stay."""
    changed = F.col(new).isNotNull() & ~F.col(new).eqNullSafe(F.col(old))
    if skip_unchanged:
        table = table.filter(changed)
    return table.withColumns({status: F.when(changed, F.lit("predicted")).otherwise(F.col(status)), old: F.when(changed, F.col(new)).otherwise(F.col(old))})


def label_objects(
    objects: DataFrame,
    scores: str,
    names: list[str],
    forward: DataFrame,
    backward: DataFrame,
    threshold: float = 0.9,
    relative: float = 0.0,
    parents: dict[str, str | None] | None = None,
    augmentation: list[tuple[list[str], list[str]]] = (),
    constraints: list[tuple[list[str], list[str]]] = (),
    filter_validated: list[str] = (),
    compatible_only: bool = True,
    skip_unchanged: bool = True,
) -> DataFrame:
    """The whole update: previous label to description, rules on it, the validated filter, scores to a description,
    unpredicted nodes, constraints, the previous description again, no negations, description to label.

    objects: object_id, object_annotation_category, object_annotation_status and `scores`. forward: display_name,
    description (space-separated names); backward: description, display_name. Validated rows keep what was known. A column
    `archive` of objects stays.
    """
    validated = F.col("object_annotation_status") == "validated"
    known = forward.select(F.col("display_name").alias("object_annotation_category"), F.split("description", " ").alias("_previous"))
    t = objects.join(known, "object_annotation_category", "left")
    t = t.withColumn("_previous", F.when(validated, F.coalesce("_previous", F.array().cast("array<string>"))))
    t = apply_rules(t, "_previous", list(augmentation), only=validated)
    if compatible_only and filter_validated:
        t = compatible(t, "_previous", validated, list(filter_validated))
    d = describe(F.col(scores), names, threshold, relative)
    t = t.withColumn("_new", exclude_unpredicted(d, parents or {}))
    t = apply_rules(t, "_new", list(constraints))
    t = t.withColumn("description", F.array_join(F.array_sort(positives(readd(F.col("_new"), F.col("_previous")))), " "))
    new = backward.select(F.array_join(F.array_sort(F.split("description", " ")), " ").alias("description"), F.col("display_name").alias("_label"))
    t = t.join(new, "description", "left")
    return update_labels(t, "_label", skip_unchanged=skip_unchanged).select(*[c for c in ("archive",) if c in objects.columns], "object_id", "object_annotation_category", "object_annotation_status", "description")

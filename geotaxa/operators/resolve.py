"""Scientific names: taken apart, and matched in spite of typos.

``parse_name`` splits a provider's spelling into genus, epithet, rank, the
epithet below the species, and authorship; the first four make its canonical
form, so spellings that differ in case, spacing, rank marks or authors agree.

``resolve_names`` looks distinct canonical forms up in a reference: equal ones
first, the rest through a *deletion neighbourhood*.  Two texts within k edits
agree on at least one text that each becomes by at most k deletions, so both
sides are listed under all of theirs (``deletion_index``; the reference's can be
stored) and meet in an equality join; the edit distance is then computed for
those pairs alone.  Work grows with the number of distinct names, never with
their square, and occurrences are joined once, by name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotaxa.functions.joins import own_shuffle
from geotaxa.operators.versions import first_per_group

# Marks of the ranks below a species, and what they become.
RANKS = {"subsp": "subsp", "ssp": "subsp", "var": "var", "forma": "f", "f": "f"}
PATTERN = (r"^(\p{L}[\p{L}-]*)(?: (\p{Ll}[\p{Ll}-]*)(?: (subsp|ssp|var|forma|f)\.? (\p{Ll}[\p{Ll}-]*))?)?(?: (.*))?$")


def parse_name(name: str | Column) -> Column:
    """(genus, epithet, rank, infra, authorship, canonical) of a spelling; parts
    that are not there are null, all are for a spelling without a genus."""
    c = F.col(name) if isinstance(name, str) else name
    text = F.trim(F.regexp_replace(c, r"\s+", " "))
    part = lambda i: F.nullif(F.regexp_extract(text, PATTERN, i), F.lit(""))
    rank = part(3)
    for mark, kept in RANKS.items():
        rank = F.when(part(3) == mark, kept).otherwise(rank)
    genus = F.initcap(part(1))
    infra = F.when(part(4).isNotNull(), F.concat(rank, F.lit(". "), part(4)))
    return F.struct(genus.alias("genus"), part(2).alias("epithet"), rank.alias("rank"), part(4).alias("infra"),
                    F.trim(part(5)).alias("authorship"),
                    F.when(genus.isNotNull(), F.concat_ws(" ", F.lower(part(1)), part(2), infra)).alias("canonical"))


def _deletions(text: Column) -> Column:
    """A text and all that it becomes by one deletion."""
    at = F.sequence(F.lit(1), F.length(text))
    shorter = F.transform(at, lambda i: F.concat(F.substr(text, F.lit(1), i - 1), F.substr(text, i + 1)))
    return F.when(F.length(text) > 0, F.array_distinct(F.concat(F.array(text), shorter))).otherwise(F.array(text))


def deletion_index(names: DataFrame, col: str = "canonical", max_distance: int = 1, out: str = "variant") -> DataFrame:
    """``names`` once per text that ``col`` becomes by at most ``max_distance``
    deletions (length + 1 rows a name for one, about half its square for two)."""
    if max_distance not in (1, 2):
        raise ValueError("max_distance is 1 or 2")
    variants = _deletions(F.col(col))
    if max_distance == 2:
        variants = F.array_distinct(F.flatten(F.transform(variants, _deletions)))
    return names.withColumn(out, F.explode(variants))


def resolve_names(names: DataFrame, reference: DataFrame, max_distance: int = 1, index: DataFrame | None = None) -> DataFrame:
    """(given_name, scientific_name, distance) of the distinct ``given_name``
    of ``names``.

    ``reference`` has ``canonical`` and ``scientific_name``; ``index`` is its
    stored ``deletion_index`` (made here if not given).  The nearest canonical
    form within ``max_distance`` edits wins.  Null where there is none, where two
    scientific names are equally near, or where the spelling cannot be parsed."""
    given = names.where("given_name is not null").select("given_name").distinct()
    given = given.withColumn("canonical", parse_name("given_name")["canonical"])
    known = reference.where("canonical is not null").groupBy("canonical").agg(F.max("scientific_name").alias("scientific_name"))
    asked = given.where("canonical is not null").select("canonical").distinct()
    exact = asked.join(known, "canonical").select("canonical", "scientific_name", F.lit(0).alias("distance"))
    rest = asked.join(known, "canonical", "left_anti")
    if index is None:
        index = deletion_index(known, max_distance=max_distance)
    listed = index.select("variant", F.col("canonical").alias("near"), "scientific_name")
    pairs = deletion_index(rest, max_distance=max_distance).join(listed, "variant").select("canonical", "near", "scientific_name").distinct()
    checked = pairs.withColumn("distance", F.levenshtein("canonical", "near", max_distance)).where("distance >= 0")
    nearest = checked.groupBy("canonical", "distance").agg(F.min("scientific_name").alias("a"), F.max("scientific_name").alias("b"))
    best = first_per_group(nearest, ["canonical"], [F.col("distance").asc()]).where("a = b")
    found = exact.unionByName(best.select("canonical", F.col("a").alias("scientific_name"), "distance"))
    return given.join(found, "canonical", "left").select("given_name", "scientific_name", "distance")


def resolve_occurrences(df: DataFrame, reference: DataFrame, name_col: str = "name", max_distance: int = 1,
                        index: DataFrame | None = None) -> DataFrame:
    """``df`` with the ``scientific_name`` its spelling resolves to and the
    ``name_distance`` of the match; each distinct spelling is resolved once and
    AQE splits the rows of a popular one."""
    kept = df.drop("scientific_name", "name_distance")
    found = resolve_names(kept.select(F.col(name_col).alias("given_name")), reference, max_distance, index)
    found = found.select(F.col("given_name").alias(name_col), "scientific_name", F.col("distance").alias("name_distance"))
    return kept.join(own_shuffle(found), on=[name_col], how="left").select(*kept.columns, "scientific_name", "name_distance")

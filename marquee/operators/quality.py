"""Splitting rows into validated and quarantined sets, and counting what is wrong."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import double_or_null, int_or_null, is_name_key, is_title_key, long_or_null, to_date10
from ..session import cut_lineage
from .dedup import latest_per_key

# The below-the-line crew categories kept from the second source.
CREW_CATEGORIES = ["cinematographer", "editor", "composer", "production_designer", "costume_designer"]


@dataclass(frozen=True)
class Rule:
    """A requirement; a row that fails it, or for which it is unknown, carries the reason."""

    reason: str
    passes: Column


@dataclass(frozen=True)
class Split:
    """Both sides of a hard check, and how many rows were given and went to each side, counted while they were stored."""

    valid: DataFrame
    quarantine: DataFrame
    raw: int
    validated: int
    quarantined: int


def failed_reasons(rules: list[Rule]) -> Column:
    """Reasons of all failed rules joined by commas, null for a clean row."""
    reasons = F.concat_ws(",", *[F.when(~F.coalesce(r.passes, F.lit(False)), F.lit(r.reason)) for r in rules])
    return F.when(reasons != "", reasons)


def split(df: DataFrame, rules: list[Rule], run_date: str) -> Split:
    """Hard checks: rows are tagged in one scan and stored; both sides read what was stored."""
    return _sides(df.withColumn("fail_reason", failed_reasons(rules)), run_date)


def _sides(tagged: DataFrame, run_date: str, raw: Observation | None = None) -> Split:
    """Stores the tagged rows; ``raw`` has observed the rows that came in, where these are others."""
    seen = Observation()
    bad = F.count_if(F.col("fail_reason").isNotNull())
    tagged = cut_lineage(tagged.observe(seen, F.count(F.lit(1)).alias("rows"), bad.alias("bad")))
    counts = seen.get
    return Split(
        valid=tagged.filter(F.col("fail_reason").isNull()).drop("fail_reason"),
        quarantine=tagged.filter(F.col("fail_reason").isNotNull()).withColumn("dq_run_date", F.lit(run_date)),
        raw=counts["rows"] if raw is None else raw.get["rows"],
        validated=counts["rows"] - counts["bad"],
        quarantined=counts["bad"],
    )


def split_required(df: DataFrame, keys: list[str], run_date: str) -> Split:
    """Null-key check: any missing part of the key quarantines the row."""
    return split(df, [Rule(f"null_{k}", F.col(k).isNotNull()) for k in keys], run_date)


def dedup_then_split(
    df: DataFrame, keys: list[str], rules: list[Rule], run_date: str, dedup_first: bool = False, **latest
) -> Split:
    """Latest row per key and the hard split together.

    Rows with a null key would collapse into one if they were deduplicated first, hiding
    how many there are; by default they are quarantined before. ``dedup_first`` gives
    the collapsing order.
    """
    if dedup_first:
        return split(latest_per_key(df, keys, **latest), rules, run_date)
    # One pass tells keyed rows from others; rows without a key are all kept by numbering them.
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
    raw = Observation()
    reason = failed_reasons(rules)
    marked = df.observe(raw, F.count(F.lit(1)).alias("rows")).withColumn("_keyless", F.when(~has_key, F.monotonically_increasing_id()))
    latest_rows = latest_per_key(marked, [*keys, "_keyless"], **latest).withColumn("fail_reason", reason)
    return _sides(latest_rows.filter(F.col("_keyless").isNull() | F.col("fail_reason").isNotNull()).drop("_keyless"), run_date, raw)


def complement(df: DataFrame, passes: Column) -> DataFrame:
    """Distinct rows for which the rule is false or unknown: the set difference
    ``df EXCEPT valid`` without joining the table to itself on every column."""
    return df.filter(~F.coalesce(passes, F.lit(False))).distinct()


def soft_counts(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row with the number of rows each check flags; rows are kept. One scan."""
    return df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()])


def summary(spark: SparkSession, tables: dict[str, Split]) -> DataFrame:
    """Per table: raw, validated and quarantined counts and the bad share in percent. Nothing is scanned:
    the counts come from storing the split rows."""
    rows = [(name, s.raw, s.validated, s.quarantined) for name, s in tables.items()]
    out = spark.createDataFrame(rows, "table_name string, raw bigint, validated bigint, quarantined bigint")
    checked = F.col("validated") + F.col("quarantined")
    pct = F.when(checked > 0, F.round(F.col("quarantined") * 100.0 / checked, 4)).otherwise(F.lit(0.0))
    return out.withColumn("pct_bad", pct)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])


def value_distribution(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def coverage(df: DataFrame, present: dict[str, Column]) -> DataFrame:
    """Total rows and, per named condition, how many rows have it and what percentage."""
    counted = df.agg(
        F.count("*").alias("total"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in present.items()]
    )
    share = [
        F.when(F.col("total") > 0, F.round(F.col(n) * 100.0 / F.col("total"), 4)).otherwise(F.lit(0.0)).alias(f"{n}_pct")
        for n in present
    ]
    return counted.select("total", *present, *share)


def orphans(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Child rows whose parent was never loaded: legal here, but worth counting."""
    return children.join(parents.select(key).distinct(), key, "left_anti")


def match_count(raw: DataFrame, raw_key: str, bridge: DataFrame, bridge_key: str) -> DataFrame:
    """How many raw rows an inner join with the bridge gives, and how many have a partner;
    the two differ when the bridge repeats keys. Keys are counted before they meet."""
    ours = raw.groupBy(F.col(raw_key).alias("_k")).agg(F.count("*").alias("_a"))
    theirs = bridge.groupBy(F.col(bridge_key).alias("_k")).agg(F.count("*").alias("_b"))
    joined = ours.join(theirs, "_k")
    return joined.agg(
        F.coalesce(F.sum(F.col("_a") * F.col("_b")), F.lit(0)).alias("joined_rows"),
        F.coalesce(F.sum("_a"), F.lit(0)).alias("matched_rows"),
    )


def spot_check(df: DataFrame, key: str, value, columns: list[str]) -> DataFrame:
    """Chosen columns of one known row."""
    return df.filter(F.col(key) == F.lit(value)).select(*columns)


# ---- rules of each source ---------------------------------------------------------


def basics_rules(first_year: int = 1880, last_year: int = 2030) -> list[Rule]:
    year = int_or_null("startYear")
    return [
        Rule("bad_tconst", is_title_key("tconst")),
        Rule("null_title", F.col("primaryTitle").isNotNull()),
        Rule("bad_year", year.between(first_year, last_year)),
    ]


def ratings_rules() -> list[Rule]:
    return [
        Rule("bad_tconst", is_title_key("tconst")),
        Rule("bad_rating", double_or_null("averageRating").between(1.0, 10.0)),
        Rule("bad_votes", long_or_null("numVotes") >= 0),
    ]


def akas_rules() -> list[Rule]:
    return [Rule("bad_title_id", is_title_key("titleId")), Rule("null_title", F.col("title").isNotNull())]


def principals_rules() -> list[Rule]:
    return [
        Rule("bad_tconst", is_title_key("tconst")),
        Rule("bad_nconst", is_name_key("nconst")),
        Rule("category_out_of_scope", F.col("category").isin(CREW_CATEGORIES)),
    ]


def names_rules() -> list[Rule]:
    return [Rule("bad_nconst", is_name_key("nconst")), Rule("null_name", F.col("primaryName").isNotNull())]


def all_pass(rules: list[Rule]) -> Column:
    passes = F.lit(True)
    for r in rules:
        passes = passes & r.passes
    return passes


def film_soft_checks(today: str, first_day: str = "2000-01-01") -> dict[str, Column]:
    """A missing metric is not counted as out of range; a missing date is counted."""
    released = to_date10("release_date")
    return {
        "bad_release": released.isNull() | (released < F.lit(first_day)) | (released > F.lit(today)),
        "bad_vote": (F.col("vote_average") < 0) | (F.col("vote_average") > 10),
        "negative_runtime": F.col("runtime") < 0,
        "null_title": F.col("title").isNull(),
    }


def people_soft_checks() -> dict[str, Column]:
    return {"null_name": F.col("name").isNull()}


def label_soft_checks(label: str) -> dict[str, Column]:
    """For relation tables, after their hard checks."""
    return {f"null_{label}": F.col(label).isNull()}


def link_soft_checks(first_year: int = 2000, last_year: int = 2030) -> dict[str, Column]:
    year = int_or_null("year")
    return {
        "bad_imdb_id": ~is_title_key("imdb_id"),
        "bad_year": year.isNull() | ~year.between(first_year, last_year),
    }


# Key columns of each second- and third-source table, as deduplicated before its checks.
DEDUP_KEYS = {
    "basics": ["tconst"],
    "ratings": ["tconst", "snapshot_date"],
    "akas": ["titleId", "ordering"],
    "principals": ["tconst", "nconst", "ordering"],
    "names": ["nconst"],
    "imdb_ids": ["wikidata_id", "imdb_id"],
    "movements": ["wikidata_id", "movement_wikidata_id"],
    "festivals": ["wikidata_id", "festival_wikidata_id"],
    "based_on": ["wikidata_id", "source_wikidata_id"],
    "influenced_by": ["wikidata_id", "influence_wikidata_id"],
}

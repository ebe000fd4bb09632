"""Build the rate model table from the reference-shaped inputs (FIXTURES.md section 1).

    spark-submit ratecraft/plans/model_table_job.py --counts 'dir/*_age*.txt' \
        --db population.db --survey survey.json --output model_table.parquet

Counts files (sectioned TSV, one per age group) are joined to population
(SQLite), rated per 100,000, pivoted by site, joined to economic indicators
(SQLite, state prefix of the 5-digit code) and to the never-smoker share of a JSON
survey; each right side is checked to be unique on its keys before its join.
"""

from __future__ import annotations

import argparse
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ratecraft.functions.columns import normalize_columns, rename, select_existing
from ratecraft.functions.scalar import prefix, rate_per, recode, to_nullable_int, truncate_int
from ratecraft.operators.aggregates import pivot_mean
from ratecraft.operators.joins import left_join
from ratecraft.session import build_session
from ratecraft.sources.files import scan_json_records, scan_sectioned_tsv
from ratecraft.sources.sinks import sink_parquet
from ratecraft.sources.sqlite import scan_sqlite_table

# Fixed values that must equal the reference's for right results:
# age-group token of a count file name -> age-group label
COUNT_AGE_GROUPS = {"agegte25lt45": "25-44", "agegte45lt65": "45-64", "agegte65": "65+"}
# age-group text of the population table -> age-group label
POPULATION_AGE_GROUPS = {"18 to 25": "18-25", "25 to 44": "25-44", "45 to 64": "45-64",
                         "65+": "65+", "Under 18": "under18"}
# survey rows kept, and the survey columns renamed to the table's names
SURVEY_MEASURE, SURVEY_RESPONSE = "Smoking Status", "Never"
SURVEY_RENAME = {"locationabbr": "states_abbr", "locationdesc": "states", "gender": "sex",
                 "data_value": "non_smoker_rate"}
SURVEY_SCHEMA = ("year bigint, locationabbr string, locationdesc string, gender string, "
                 "measuredesc string, response string, data_value double")
# raw count columns typed as integers; every other column (codes included) stays text
COUNT_INT_COLUMNS = ("Year",)
# normalised name of the count files' site column: its levels become the target columns
SITE_COLUMN = "leading_cancer_sites"
PIVOT_INDEX = ["states", "fips", "year", "sex", "sex_code", "age_group", "population"]


def header_schema(spark: SparkSession, path: str, int_columns=COUNT_INT_COLUMNS) -> StructType:
    """Schema from the header line of one count file (one line read on the driver)."""
    first = spark.read.text(path).first()
    if first is None:
        raise ValueError(f"empty file {path}")
    names = [h.strip().strip('"') for h in first[0].rstrip("\r").split("\t")]
    return StructType([StructField(n, LongType() if n in int_columns else StringType())
                       for n in names])


def counts_table(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All count files by column name: files that share a header are one scan, scans with
    different headers are united by name (a column that one lacks is NULL there)."""
    by_header: dict = {}
    for p in paths:
        schema = header_schema(spark, p)
        by_header.setdefault(tuple(schema.names), (schema, []))[1].append(p)
    scans = [normalize_columns(scan_sectioned_tsv(spark, files, schema, file_column="age_group"))
             for schema, files in by_header.values()]
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
    return (df.withColumn("count", to_nullable_int("count"))
            .withColumn("age_group", recode("age_group", COUNT_AGE_GROUPS)))


def build_model_table(spark: SparkSession, count_paths: list[str], db: str, survey_json: str) -> DataFrame:
    counts = rename(counts_table(spark, count_paths), {"states_code": "fips"})
    pop = scan_sqlite_table(spark, db, "population").withColumn(
        "age_group", recode("age_group", POPULATION_AGE_GROUPS))
    rated = left_join(counts, pop, ["fips", "year", "sex", "age_group"], validate="many_to_one")
    rated = rated.withColumns({
        "crude_rate": truncate_int(rate_per("count", "population")),
        "population": truncate_int(F.col("population").cast("double"))})
    wide = pivot_mean(rated, PIVOT_INDEX, SITE_COLUMN, "crude_rate")
    sites = [c for c in wide.columns if c not in PIVOT_INDEX]
    wide = wide.withColumns({c: truncate_int(c) for c in sites})
    econ = scan_sqlite_table(spark, db, "economic_indicators").withColumn("fips", prefix("fips", 2))
    table = left_join(wide, econ, ["fips", "year"], validate="many_to_one")
    survey = scan_json_records(spark, survey_json, SURVEY_SCHEMA)
    survey = survey.where((F.col("measuredesc") == SURVEY_MEASURE) &
                          (F.col("response") == SURVEY_RESPONSE))
    survey = select_existing(rename(survey, SURVEY_RENAME),
                             ["year", "states_abbr", "states", "non_smoker_rate", "sex"])
    return left_join(table, survey, ["states", "year", "sex"], validate="many_to_one")


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="build the rate model table")
    ap.add_argument("--counts", required=True, help="glob of sectioned count files")
    ap.add_argument("--db", required=True, help="SQLite file with population and economic_indicators")
    ap.add_argument("--survey", required=True, help="JSON array of survey records")
    ap.add_argument("--output", required=True)
    a = ap.parse_args(argv)
    spark = build_session(app_name="ratecraft-model-table")
    # listed by Spark, so the files may lie in any store it reads; only names are read
    paths = [r["path"] for r in spark.read.format("binaryFile").load(a.counts).select("path").orderBy("path").collect()]
    sink_parquet(build_model_table(spark, paths, a.db, a.survey), a.output)


__all__ = ["build_model_table", "counts_table", "header_schema", "main"]

if __name__ == "__main__":
    main()

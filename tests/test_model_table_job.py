"""End-to-end build of the model table from reference-shaped inputs (FIXTURES.md 1)."""

import json
import os
import sqlite3

import pytest

from ratecraft.errors import DuplicateKeyError
from ratecraft.plans.model_table_job import build_model_table, main

HEAD = ["Notes", "States", "States Code", "Year", "Year Code", "Leading Cancer Sites", "Sex",
        "Sex Code", "Count"]


def _counts(path, rows):
    with open(path, "w") as f:
        f.write("\t".join(f'"{h}"' for h in HEAD) + "\n")
        for r in rows:
            f.write("\t".join(["", f'"{r[0]}"', f'"{r[1]}"', str(r[2]), str(r[2]), f'"{r[3]}"',
                               f'"{r[4]}"', f'"{r[5]}"', r[6]]) + "\n")
        f.write('"---"\n"Dataset: counts"\n"---"\n"Suppressed: fewer than 16"\n')


@pytest.fixture()
def inputs(tmpdir_path):
    d = tmpdir_path
    _counts(os.path.join(d, "cnt_agegte25lt45.txt"), [
        ("Alabama", "01", 2001, "Breast", "Female", "F", "120"),
        ("Alabama", "01", 2001, "Lung and Bronchus", "Female", "F", "Suppressed"),
        ("Alabama", "01", 2001, "Breast", "Male", "M", "3")])
    _counts(os.path.join(d, "cnt_agegte65.txt"), [
        ("Alaska", "02", 2002, "Breast", "Female", "F", "50"),
        ("Alaska", "02", 2002, "Lung and Bronchus", "Female", "F", "4")])
    db = os.path.join(d, "pop.db")
    con = sqlite3.connect(db)
    con.execute("CREATE TABLE population (fips TEXT, year INTEGER, sex TEXT, age_group TEXT, population INTEGER)")
    con.executemany("INSERT INTO population VALUES (?,?,?,?,?)", [
        ("01", 2001, "Female", "25 to 44", 100000), ("01", 2001, "Male", "25 to 44", 100000),
        ("02", 2002, "Female", "65+", 20000), ("02", 2002, "Male", "65+", 19000)])
    con.execute("CREATE TABLE economic_indicators (fips TEXT, year INTEGER, gdp REAL, n_jobs REAL)")
    con.executemany("INSERT INTO economic_indicators VALUES (?,?,?,?)",
                    [("01000", 2001, 1.5, 10.0), ("02000", 2002, 2.5, 20.0)])
    con.commit()
    con.close()
    js = os.path.join(d, "survey.json")
    with open(js, "w") as f:
        json.dump([
            {"year": 2001, "locationabbr": "AL", "locationdesc": "Alabama", "gender": "Female",
             "measuredesc": "Smoking Status", "response": "Never", "data_value": 55.0},
            {"year": 2001, "locationabbr": "AL", "locationdesc": "Alabama", "gender": "Female",
             "measuredesc": "Smoking Status", "response": "Current", "data_value": 20.0}], f)
    return d, db, js


def test_build_model_table(spark, inputs):
    d, db, js = inputs
    paths = [os.path.join(d, "cnt_agegte25lt45.txt"), os.path.join(d, "cnt_agegte65.txt")]
    t = build_model_table(spark, paths, db, js)
    assert t.columns[:9] == ["states", "fips", "year", "sex", "sex_code", "age_group", "population",
                             "breast", "lung_and_bronchus"]
    rows = {(r["states"], r["sex"]): r.asDict() for r in t.collect()}
    assert len(rows) == 3
    al_f = rows[("Alabama", "Female")]
    assert (al_f["fips"], al_f["age_group"], al_f["population"]) == ("01", "25-44", 100000)
    # 120 / 100000 * 100000 is 119.99..., truncated: the quotient is taken before it is scaled
    assert al_f["breast"] == 119 and al_f["lung_and_bronchus"] is None  # Suppressed -> NULL
    assert (al_f["gdp"], al_f["non_smoker_rate"], al_f["states_abbr"]) == (1.5, 55.0, "AL")
    assert rows[("Alabama", "Male")]["breast"] == 3 and rows[("Alabama", "Male")]["non_smoker_rate"] is None
    ak = rows[("Alaska", "Female")]
    assert (ak["age_group"], ak["breast"], ak["lung_and_bronchus"], ak["gdp"]) == ("65+", 250, 20, 2.5)


def test_duplicate_population_key_raises(spark, inputs):
    d, db, js = inputs
    con = sqlite3.connect(db)
    con.execute("INSERT INTO population VALUES ('01', 2001, 'Female', '25 to 44', 5)")
    con.commit()
    con.close()
    with pytest.raises(DuplicateKeyError):
        build_model_table(spark, [os.path.join(d, "cnt_agegte25lt45.txt")], db, js)


def test_job_cli_writes_parquet(spark, inputs):
    d, db, js = inputs
    out = os.path.join(d, "model.parquet")
    main(["--counts", os.path.join(d, "cnt_*.txt"), "--db", db, "--survey", js, "--output", out])
    assert spark.read.parquet(out).count() == 3


def test_analysis_job(spark, inputs):
    from ratecraft.plans.analysis_job import analyse, main as analysis_main
    d, db, js = inputs
    paths = [os.path.join(d, "cnt_agegte25lt45.txt"), os.path.join(d, "cnt_agegte65.txt")]
    t = build_model_table(spark, paths, db, js)
    out = analyse(t, ["breast", "lung_and_bronchus"])
    ranks = {(r["group_col"], r["group"], r["target"]): (r["mean_rate"], r["rank"])
             for r in out["rankings"].collect()}
    # breast by state: Alaska 250, Alabama mean(119, 3) = 61; female mean(119, 250) = 184.5 -> 184
    assert ranks[("states", "Alaska", "breast")] == (250, 1)
    assert ranks[("states", "Alabama", "breast")] == (61, 2)
    assert ranks[("sex", "Female", "breast")] == (184, 1) and ranks[("sex", "Male", "breast")] == (3, 2)
    cc = out["cross_correlation"].collect()
    assert {r["group"] for r in cc} == {"25-44", "65+", "all"}
    assert {r["target"] for r in cc} == {"breast", "lung_and_bronchus"}
    table = os.path.join(d, "mt.parquet")
    t.write.parquet(table)
    analysis_main(["--table", table, "--targets", "breast,lung_and_bronchus",
                   "--output", os.path.join(d, "analysis")])
    assert spark.read.parquet(os.path.join(d, "analysis", "rankings")).count() == len(ranks)

"""Cleaning, yearly statistics and longevity."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from permitry.operators import metrics
from permitry.operators.clean import clean_licences, with_longevity, with_origin, with_status
from permitry.schemas import CLOSED_STATUSES_LITERAL, LICENCE, STATUSES

from permitry.plans import trends


def licence(origin="Van", name="A", status="Issued", issued="2012-10-01", expiry=None, kind="Spa"):
    return (origin, name, status, issued, expiry, kind, "", "", "", None, None)


def table(spark, *rows):
    return spark.createDataFrame(list(rows), LICENCE)


@pytest.fixture(scope="module")
def many(spark):
    """Licences with every odd case: short lives, same days, year ends, missing dates, all statuses."""
    random.seed(7)
    first = dt.date(1994, 1, 1)
    rows = []
    for i in range(600):
        issued = first + dt.timedelta(days=random.randrange(24 * 365))
        if i % 11 == 0:
            issued = dt.date(issued.year, 12, 31)
        life = random.choice([None, -40, 0, 1, 200, 900, 3000])
        expiry = None if life is None else issued + dt.timedelta(days=life)
        if i % 13 == 0 and expiry:
            expiry = dt.date(expiry.year, 12, 31)
        rows.append(licence(random.choice(["Van", "Tor"]), f"N{i}", random.choice(STATUSES), str(issued),
                            expiry and str(expiry), random.choice(["Spa", "Bar", "Law", None])))
    rows.append(licence(issued="nonsense"))
    return clean_licences(table(spark, *rows)).cache()


def brute_force(rows, statuses, by, years):
    groups = {}
    for r in rows:
        if statuses is not None and r.Status not in statuses:
            continue
        for year in range(years[0], years[1] + 1):
            if r.IssuedYear > year:
                continue
            end = dt.date(year, 12, 31)
            to = min(r.ExpiryDate, end) if r.ExpiryDate else end
            days = (to - r.IssuedDate).days
            if days > 0:
                key = (*[r[c] for c in by], year, r.BusinessType)
                n, total = groups.get(key, (0, 0))
                groups[key] = (n + 1, total + days)
    return {k: (n, total / n, total / n / 365) for k, (n, total) in groups.items()}


@pytest.mark.parametrize("statuses", [None, ["Issued", "Open"], ["Cancelled", "Closed", "Gone Out of Business"]])
@pytest.mark.parametrize("by", [(), ("DataSetOrigin",)])
@pytest.mark.parametrize("years", [(1998, 2016), (2010, 2010), (1990, 1995), (2016, 2030)])
def test_longevity_equals_yearly_loop(many, statuses, by, years):
    found = metrics.longevity(many, statuses, by, years).collect()
    expected = brute_force(many.collect(), statuses, by, years)
    got = {(*[r[c] for c in by], r.year, r.BusinessType): (r.NumBusiness, r.AvgLongevity, r.AvgLongevityYears) for r in found}
    assert got == expected


def test_longevity_worked_examples(spark):
    rows = [licence(expiry=e) for e in (None, "2015-10-01", "2014-05-01", "2013-03-01", "2012-10-01", "2011-01-01")]
    rows.append(licence(issued="2015-01-01"))
    found = metrics.longevity(clean_licences(table(spark, *rows)), years=(2014, 2014)).collect()
    assert [(r.NumBusiness, r.AvgLongevity) for r in found] == [(4, (821 + 821 + 577 + 151) / 4)]


def test_longevity_invariant_under_partitioning(many, rows):
    assert rows(metrics.longevity(many.repartition(7))) == rows(metrics.longevity(many.coalesce(1)))


def test_named_longevity_tables(many):
    assert metrics.longevity_per_year(many).columns == [
        "year", "BusinessType", "NumBusiness", "AvgLongevityDays", "AvgLongevityYears"]
    assert metrics.longevity_of_issued_per_year(many).columns[3] == "AvgLongevity"
    assert metrics.longevity_of_issued_per_city(many).columns[0] == "DataSetOrigin"
    ordered = metrics.by_year(metrics.longevity_of_closed_per_year(many), "BusinessType").collect()
    assert ordered == sorted(ordered, key=lambda r: (r.year, -r.NumBusiness, r.BusinessType or ""))


def test_one_scan_for_all_years(many):
    plan = metrics.longevity(many.where("Status = 'Open'"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert "PythonEval" not in plan and "ArrowEval" not in plan


def test_compact_gives_the_same_statistics(many, rows):
    small = metrics.compact(many)
    assert small.count() < many.count()
    for name, table in trends.statistics(small, (2000, 2012)).items():
        assert rows(table) == rows(trends.statistics(many, (2000, 2012))[name]), name
    assert rows(metrics.longevity_of_issued_per_city(small)) == rows(metrics.longevity_of_issued_per_city(many))
    assert rows(metrics.top_types(small, ["Open"], 2)) == rows(metrics.top_types(many, ["Open"], 2))


def test_row_longevity(many):
    aged = with_longevity(many, 2005).where("Longevity > 0 AND IssuedYear <= 2005")
    total = metrics.longevity(many, years=(2005, 2005)).agg(F.sum("NumBusiness")).first()[0]
    assert aged.count() == total


def test_clean(spark):
    data = table(
        spark, licence(name="keep"), licence(name="short", issued="2012"), licence(name="junk", issued="2012/10/01x"),
        licence(name=None), licence(name="nodate", issued=None), licence(name="x", issued="31-DEC-2011", expiry="junk"),
        licence(name="", issued="2010-01-01 00:00:00", expiry="2011-02-03"))
    found = sorted(clean_licences(data).select("BusinessName", "IssuedYear", "ExpiryYear").collect())
    assert [tuple(r) for r in found] == [("", 2010, 2011), ("keep", 2012, None), ("x", 2011, None)]
    assert {r.BusinessName for r in clean_licences(data, min_name_length=2).collect()} == {"keep"}


def test_status_and_origin(many):
    assert {r.Status for r in with_status(many, ["Open"]).select("Status").distinct().collect()} == {"Open"}
    assert {r.DataSetOrigin for r in with_origin(many, "Tor").select("DataSetOrigin").distinct().collect()} == {"Tor"}
    assert {r.Status for r in metrics.distinct_statuses(many).collect()} == set(STATUSES)


def test_opens_and_closes(spark, rows):
    data = clean_licences(table(
        spark, licence(), licence(status="Open"), licence(kind="Bar"), licence(issued="2013-01-01"),
        licence(status="Closed", expiry="2014-01-01"), licence(status="Gone Out of Business", expiry="2014-05-01"),
        licence(status="Cancelled", expiry="2015-05-01"), licence(status="Closed"), licence(status="Pending")))
    assert rows(metrics.opens_per_year(data)) == [("Bar", 2012, 1), ("Spa", 2012, 2), ("Spa", 2013, 1)]
    assert rows(metrics.closes_per_year(data)) == [("Spa", 2014, 2), ("Spa", 2015, 1)]
    assert rows(metrics.closes_per_year(data, CLOSED_STATUSES_LITERAL)) == [("Spa", 2015, 1)]


def test_top_types_and_ties(spark, rows):
    kinds = ["A"] * 3 + ["C"] * 2 + ["B"] * 2 + ["D"]
    data = clean_licences(table(spark, *[licence(kind=k, status="Closed") for k in kinds]))
    top = metrics.top_types(data, ["Closed"], 3).collect()
    assert [tuple(r) for r in top] == [("A", 3), ("B", 2), ("C", 2)]
    assert rows(metrics.top_closes_per_year(data)) == []


def test_top_closes_counts_undated(spark, rows):
    data = clean_licences(table(
        spark, *[licence(kind="A", status="Closed") for _ in range(3)], licence(kind="A", status="Closed", expiry="2014-01-01"),
        *[licence(kind="B", status="Closed", expiry="2014-01-01") for _ in range(2)]))
    assert rows(metrics.top_closes_per_year(data, n=1)) == [("A", 2014, 1)]
    assert rows(metrics.top_opens_per_year(data.withColumn("Status", F.lit("Open")), n=1)) == [("A", 2012, 4)]


def test_null_type_in_top(spark, rows):
    data = clean_licences(table(spark, licence(kind=None), licence(kind=None), licence(kind="B")))
    assert rows(metrics.opens_per_year(data)) == [(None, 2012, 2), ("B", 2012, 1)]


def test_write_statistics(spark, many, tmp_path):
    trends.write_statistics(many, str(tmp_path), years=(2000, 2003))
    back = spark.read.csv(str(tmp_path / "van" / "opens_per_year"), header=True)
    assert back.columns == ["BusinessType", "IssuedYear", "NumOpens"]
    expected = metrics.opens_per_year(with_origin(many, "Van")).agg(F.sum("NumOpens")).first()[0]
    assert back.agg(F.sum(F.col("NumOpens").cast("int"))).first()[0] == expected
    assert {p.name for p in (tmp_path / "all").iterdir()} == set(trends.statistics(many))

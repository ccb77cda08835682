"""Sales and country operators against direct joins on a small catalog with gaps and a hot track."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rosterline.operators import countries, sales
from rosterline.schemas import COUNTRY


@pytest.fixture(scope="module")
def catalog(spark):
    artist = spark.createDataFrame([(1, "One"), (2, "Two"), (3, "None")], "ArtistId int, Name string")
    album = spark.createDataFrame([(10, "A", 1), (11, "B", 1), (20, "C", 2)], "AlbumId int, Title string, ArtistId int")
    genre = spark.createDataFrame([(1, "Rock"), (2, "Jazz"), (3, "Empty")], "GenreId int, Name string")
    track = spark.createDataFrame(
        [(100, "t0", 10, 1, 60000), (101, "t1", 10, 1, 120000), (102, "t2", 20, 2, 90000), (103, "t3", None, 1, None)],
        "TrackId int, Name string, AlbumId int, GenreId int, Milliseconds int",
    )
    lines = [(i, 1000 + i % 50, 100, Decimal("0.99"), 1) for i in range(300)]  # one track holds nearly all lines
    lines += [(900, 1000, 102, Decimal("1.99"), 3), (901, 1001, 103, Decimal("1.99"), 2), (902, 1002, 555, Decimal("9.99"), 1)]
    line = spark.createDataFrame(
        lines, "InvoiceLineId int, InvoiceId int, TrackId int, UnitPrice decimal(10,2), Quantity int"
    )
    for name, df in (("artist", artist), ("album", album), ("genre", genre), ("track", track), ("line", line)):
        df.createOrReplaceTempView(name)
    return {"artist": artist, "album": album, "genre": genre, "track": track, "line": line}


def same(left, right):
    assert sorted(map(tuple, left.collect()), key=str) == sorted(map(tuple, right.collect()), key=str)


def test_artist_summary_is_the_direct_join(spark, catalog):
    c = catalog
    direct = spark.sql(
        """SELECT a.ArtistId, a.Name, count(DISTINCT al.AlbumId), count(DISTINCT t.TrackId), coalesce(sum(Quantity), 0),
        CAST(coalesce(sum(UnitPrice * Quantity), 0) AS DECIMAL(28,2)),
        CAST(round(coalesce(avg(UnitPrice), 0), 2) AS DECIMAL(18,2))
        FROM artist a LEFT JOIN album al ON a.ArtistId = al.ArtistId LEFT JOIN track t ON al.AlbumId = t.AlbumId
        LEFT JOIN line l ON t.TrackId = l.TrackId GROUP BY a.ArtistId, a.Name"""
    )
    same(sales.artist_sales_summary(c["artist"], c["album"], c["track"], c["line"]), direct)


def test_genre_summary_is_the_direct_join(spark, catalog):
    c = catalog
    direct = spark.sql(
        """SELECT g.GenreId, g.Name, count(DISTINCT t.TrackId), count(DISTINCT al.AlbumId), coalesce(sum(Quantity), 0),
        CAST(coalesce(sum(UnitPrice * Quantity), 0) AS DECIMAL(28,2)),
        CAST(coalesce(round(avg(Milliseconds) / 60000, 2), 0) AS DECIMAL(18,2))
        FROM genre g LEFT JOIN track t ON g.GenreId = t.GenreId LEFT JOIN album al ON t.AlbumId = al.AlbumId
        LEFT JOIN line l ON t.TrackId = l.TrackId GROUP BY g.GenreId, g.Name"""
    )
    popularity = sales.genre_popularity(c["genre"], c["track"], c["album"], c["line"])
    same(popularity, direct)
    plain = sales.genre_popularity(c["genre"], c["track"], c["album"], c["line"], weighted=False)
    assert plain.filter("GenreId = 1").first()["avg_track_minutes"] == Decimal("1.50")
    empty = sales.genre_report(c["genre"], c["track"], c["album"], c["line"]).filter("genre_id = 3").first()
    assert (empty["track_count"], empty["total_sales"], empty["revenue_per_track"]) == (0, 0, None)


def test_inner_forms_drop_what_was_not_sold(spark, catalog):
    c = catalog
    top = sales.artist_revenue(c["artist"], c["album"], c["track"], c["line"])
    assert [tuple(r) for r in top.collect()] == [("One", 1, Decimal("297.00")), ("Two", 1, Decimal("5.97"))]
    everyone = sales.artist_revenue_all(c["artist"], c["album"], c["track"], c["line"])
    assert [r["artist_name"] for r in everyone.collect()] == ["One", "Two", "None"]
    performance = {r["genre"]: tuple(r)[1:] for r in sales.genre_performance(c["genre"], c["track"], c["album"], c["line"]).collect()}
    assert performance == {"Rock": (301, 1, 300), "Jazz": (1, 1, 3)}  # 300 sold lines and one unsold track


def invoices(spark):
    rows = [
        (1, 1, dt.datetime(2009, 1, 1), "10.00"),
        (2, 1, dt.datetime(2009, 12, 31), "10.01"),
        (3, 2, dt.datetime(2009, 12, 31, 0, 0, 1), "40.01"),
        (4, 2, dt.datetime(2010, 1, 1), "1.00"),
        (5, 3, dt.datetime(2008, 12, 31, 23, 59), "20.00"),
    ]
    return spark.createDataFrame(
        [(i, c, t, Decimal(v)) for i, c, t, v in rows],
        "InvoiceId int, CustomerId int, InvoiceDate timestamp_ntz, Total decimal(10,2)",
    )


def customers(spark):
    return spark.createDataFrame(
        [(i, "F", str(i), f"{i}@x.org", "India" if i < 3 else "Finland") for i in range(1, 5)],
        "CustomerId int, FirstName string, LastName string, Email string, Country string",
    )


def test_lifetime_value_segments(spark):
    rows = {r["CustomerId"]: r for r in sales.customer_lifetime_value(customers(spark), invoices(spark)).collect()}
    assert [rows[i]["customer_segment"] for i in (1, 2, 3, 4)] == ["Medium Value", "High Value", "Low Value", "Low Value"]
    assert rows[1]["avg_order_value"] == Decimal("10.005") and rows[4]["total_orders"] == 0
    assert rows[4]["lifetime_value"] == 0 and rows[4]["first_purchase"] is None


def test_monthly_reports(spark):
    report = sales.monthly_revenue(invoices(spark), 2009)
    assert [(r["month_num"], r["month_name"], r["order_count"], r["unique_customers"]) for r in report.collect()] == [
        (1, "January", 1, 1),
        (12, "December", 2, 2),
    ]
    assert sales.monthly_revenue(invoices(spark), 2009, padded=True).first()["month_name"] == "January  "
    between = sales.monthly_sales(invoices(spark), "2009-01-01", "2009-12-31")
    assert [(r["month"].month, r["order_count"]) for r in between.collect()] == [(1, 1), (12, 1)]


def test_months_do_not_depend_on_the_time_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
        report = sales.monthly_revenue(invoices(spark), 2009).collect()
        months = sales.monthly_sales(invoices(spark), "2009-01-01", "2009-12-31").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [(r["month_num"], r["order_count"]) for r in report] == [(1, 1), (12, 2)]
    assert [r["month"] for r in months] == [dt.datetime(2009, 1, 1), dt.datetime(2009, 12, 1)]


def test_sales_by_country(spark):
    rows = [tuple(r)[:3] for r in sales.sales_by_country(customers(spark), invoices(spark)).collect()]
    assert rows == [("India", 2, Decimal("61.02")), ("Finland", 1, Decimal("20.00"))]


def test_purchase_history_order(spark, catalog):
    invoice = spark.createDataFrame(
        [(1000, 7, dt.datetime(2009, 1, 1)), (1001, 7, dt.datetime(2009, 2, 1)), (1002, 8, dt.datetime(2009, 2, 1))],
        "InvoiceId int, CustomerId int, InvoiceDate timestamp_ntz",
    )
    history = sales.purchase_history(7, invoice, catalog["line"], catalog["track"], catalog["album"], catalog["artist"])
    rows = history.collect()
    assert {r["invoice_id"] for r in rows} == {1000, 1001} and rows[0]["invoice_id"] == 1001
    assert rows[-1]["line_total"] == Decimal("5.97") and len(rows) == 13


def test_album_details_and_search(catalog):
    details = sales.album_details(10, catalog["album"], catalog["track"], catalog["artist"]).collect()
    assert [(r["album_title"], r["artist_name"], r["TrackId"]) for r in details] == [("A", "One", 100), ("A", "One", 101)]
    assert [r["TrackId"] for r in sales.search_tracks(catalog["track"], "T1").collect()] == [101]


@pytest.fixture(scope="module")
def country(spark):
    rows = [(1, "Finland", "7.77"), (2, "Norway", "6.00"), (3, "India", "4.02")]
    df = spark.createDataFrame([(i, n, Decimal(s)) for i, n, s in rows], "overall_rank int, country_or_region string, s decimal(5,2)")
    names = [part.strip().split(" ") for part in COUNTRY.replace("decimal(5,2)", "decimal(10,2)").split(", ")]
    extra = [F.col("s").cast("decimal(10,2)").alias(n) for n, _ in names if n not in ("overall_rank", "country_or_region", "score")]
    return df.select("overall_rank", "country_or_region", F.col("s").alias("score"), *extra)


def test_thresholds_differ_at_the_bound(country):
    assert [r["country"] for r in countries.countries_at_least(country, "6.0").collect()] == ["Finland", "Norway"]
    assert [r["country_or_region"] for r in countries.countries_above(country, "6.0").collect()] == ["Finland"]


def test_compare_countries(country):
    rows = countries.compare_countries(country, "india", "FINLAND").collect()
    assert [r["metric"] for r in rows] == list(countries.METRICS.values())
    assert tuple(rows[0])[1:] == (Decimal("4.02"), Decimal("7.77"), Decimal("-3.75"))
    assert countries.compare_countries(country, "India", "India").first()["difference"] == 0
    with pytest.raises(Exception, match="One or both countries not found"):
        countries.compare_countries(country, "India", "Atlantis").collect()


def test_regional_averages(spark, country):
    regions = spark.createDataFrame([("Finland", "Europe"), ("Norway", "Europe"), ("India", "Asia")], "country_or_region string, region string")
    rows = {r["region"]: (r["countries"], r["avg_score"]) for r in countries.regional_averages(country, regions).collect()}
    assert rows == {"Europe": (2, Decimal("6.89")), "Asia": (1, Decimal("4.02"))}

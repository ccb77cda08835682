"""Sales summaries, reports and benchmark queries.

The line fact is folded per track first and then rolled up the hierarchy track → album → artist (or
track → genre). Every join meets one row per key on both sides and no multi-distinct expansion occurs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterline.functions.grades import average

MONEY = "decimal(28,2)"


def line_amount() -> Column:
    return F.col("UnitPrice") * F.col("Quantity")


def line_totals(line: DataFrame) -> DataFrame:
    """Per track: lines, units, revenue, and the sum and count of line prices."""
    return line.groupBy("TrackId").agg(
        F.count("*").alias("lines"),
        F.sum("Quantity").alias("units"),
        F.sum(line_amount()).cast(MONEY).alias("revenue"),
        F.sum("UnitPrice").cast(MONEY).alias("price_sum"),
        F.count("UnitPrice").alias("priced"),
    )


MEASURES = ("units", "revenue", "price_sum", "priced")


def _summed(*names: str) -> list[Column]:
    return [F.sum(n).cast(MONEY if n in ("revenue", "price_sum") else "long").alias(n) for n in names]


def zero_money(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast(MONEY))


def artist_measures(
    artist: DataFrame, album: DataFrame, track: DataFrame, line: DataFrame, how: str = "left"
) -> DataFrame:
    """Albums, tracks and sales measures per artist; ``how='inner'`` counts only what was sold."""
    tracks = (
        track.select("TrackId", "AlbumId")
        .join(line_totals(line), "TrackId", how)
        .groupBy("AlbumId")
        .agg(F.count("TrackId").alias("tracks"), *_summed(*MEASURES))
    )
    albums = (
        album.select("AlbumId", "ArtistId")
        .join(tracks, "AlbumId", how)
        .groupBy("ArtistId")
        .agg(
            F.count("AlbumId").alias("total_albums"),
            F.sum("tracks").alias("total_tracks"),
            *_summed(*MEASURES),
        )
    )
    return artist.select("ArtistId", F.col("Name").alias("artist_name")).join(albums, "ArtistId", how)


def artist_sales_summary(artist: DataFrame, album: DataFrame, track: DataFrame, line: DataFrame) -> DataFrame:
    price = average(F.col("price_sum"), F.col("priced"))
    return artist_measures(artist, album, track, line).select(
        "ArtistId",
        "artist_name",
        F.coalesce("total_albums", F.lit(0)).alias("total_albums"),
        F.coalesce("total_tracks", F.lit(0)).alias("total_tracks"),
        F.coalesce("units", F.lit(0)).alias("total_units_sold"),
        zero_money("revenue").alias("total_revenue"),
        F.coalesce(price, F.lit(0)).cast("decimal(18,2)").alias("avg_track_price"),
    )


def genre_measures(
    genre: DataFrame, track: DataFrame, album: DataFrame, line: DataFrame, how: str = "left"
) -> DataFrame:
    """Per genre: tracks, known albums, sales, and track length weighted by the sold lines.

    A track weighs once per sold line and once if unsold, as in a direct join of tracks and lines.
    ``how='inner'`` drops tracks without a known album and genres without tracks.
    """
    weight = F.greatest(F.coalesce("lines", F.lit(0)), F.lit(1))
    timed = F.col("Milliseconds").isNotNull().cast("long")
    per_album = (
        track.select("TrackId", "GenreId", "AlbumId", "Milliseconds")
        .join(line_totals(line), "TrackId", "left")
        .groupBy("GenreId", "AlbumId")
        .agg(
            F.count("TrackId").alias("tracks"),
            F.sum(weight).alias("joined_rows"),
            F.sum(F.col("Milliseconds").cast("decimal(20,0)") * weight).cast("decimal(38,0)").alias("weighted_ms"),
            F.sum(timed * weight).alias("weights"),
            F.sum(F.col("Milliseconds")).alias("plain_ms"),
            F.sum(timed).alias("timed_tracks"),
            *_summed("units", "revenue"),
        )
    )
    known = album.select("AlbumId", F.col("AlbumId").alias("KnownAlbum"))
    totals = (
        per_album.join(known, "AlbumId", how)
        .groupBy("GenreId")
        .agg(
            F.count("KnownAlbum").alias("album_count"),  # one row per (genre, album) here
            F.sum("tracks").alias("track_count"),
            F.sum("joined_rows").alias("joined_rows"),
            F.sum("weighted_ms").cast("decimal(38,0)").alias("weighted_ms"),
            F.sum("weights").alias("weights"),
            F.sum("plain_ms").alias("plain_ms"),
            F.sum("timed_tracks").alias("timed_tracks"),
            *_summed("units", "revenue"),
        )
    )
    return genre.select("GenreId", F.col("Name").alias("genre_name")).join(totals, "GenreId", how)


def _minutes(weighted: bool) -> Column:
    total, count = ("weighted_ms", "weights") if weighted else ("plain_ms", "timed_tracks")
    milliseconds = F.col(total).cast("decimal(28,0)")
    per_minute = F.nullif(F.col(count), F.lit(0)).cast("decimal(19,0)") * F.lit(60000)
    minutes = F.round(milliseconds / per_minute, 2)
    return F.coalesce(minutes, F.lit(0)).cast("decimal(18,2)")


def genre_popularity(
    genre: DataFrame, track: DataFrame, album: DataFrame, line: DataFrame, weighted: bool = True
) -> DataFrame:
    return genre_measures(genre, track, album, line).select(
        "GenreId",
        "genre_name",
        F.coalesce("track_count", F.lit(0)).alias("track_count"),
        F.coalesce("album_count", F.lit(0)).alias("album_count"),
        F.coalesce("units", F.lit(0)).alias("total_sales"),
        zero_money("revenue").alias("total_revenue"),
        _minutes(weighted).alias("avg_track_minutes"),
    )


def genre_report(
    genre: DataFrame, track: DataFrame, album: DataFrame, line: DataFrame, weighted: bool = True
) -> DataFrame:
    popularity = genre_popularity(genre, track, album, line, weighted)
    return popularity.select(
        F.col("GenreId").alias("genre_id"),
        "genre_name",
        "track_count",
        "album_count",
        "total_sales",
        "total_revenue",
        F.col("avg_track_minutes").alias("avg_track_length_mins"),
        average(F.col("total_revenue"), F.col("track_count")).cast("decimal(18,2)").alias("revenue_per_track"),
    ).orderBy(F.desc("total_revenue"), "genre_id")


def customer_lifetime_value(
    customer: DataFrame, invoice: DataFrame, high: str = "40", medium: str = "20"
) -> DataFrame:
    return lifetime_value(customer, orders_per_customer(invoice), high, medium)


def orders_per_customer(invoice: DataFrame) -> DataFrame:
    return invoice.groupBy("CustomerId").agg(
        F.count("InvoiceId").alias("orders"),
        F.sum("Total").cast(MONEY).alias("spent"),
        F.count("Total").alias("priced"),
        F.min("InvoiceDate").alias("first_purchase"),
        F.max("InvoiceDate").alias("last_purchase"),
    )


def lifetime_value(customer: DataFrame, orders: DataFrame, high: str = "40", medium: str = "20") -> DataFrame:
    """From the orders per customer, as ``orders_per_customer`` or a maintained state gives them."""
    spent = F.col("spent")
    segment = (
        F.when(spent > F.lit(high).cast(MONEY), F.lit("High Value"))
        .when(spent > F.lit(medium).cast(MONEY), F.lit("Medium Value"))
        .otherwise(F.lit("Low Value"))
    )
    mean = (spent.cast("decimal(24,2)") / F.nullif(F.col("priced"), F.lit(0)).cast("decimal(12,0)"))
    return customer.join(orders, "CustomerId", "left").select(
        "CustomerId",
        F.concat("FirstName", F.lit(" "), "LastName").alias("customer_name"),
        "Email",
        "Country",
        F.coalesce("orders", F.lit(0)).alias("total_orders"),
        zero_money("spent").alias("lifetime_value"),
        F.coalesce(mean, F.lit(0)).alias("avg_order_value"),
        "first_purchase",
        "last_purchase",
        segment.alias("customer_segment"),
    )


def top_by(summary: DataFrame, measure: str, key: str, limit: int = 10) -> DataFrame:
    """Top rows of a stored summary: each task keeps its best ``limit`` rows."""
    return summary.orderBy(F.desc(measure), key).limit(limit)


def in_segment(lifetime_value: DataFrame, segment: str = "High Value") -> DataFrame:
    return lifetime_value.filter(F.col("customer_segment") == segment)


def top_artists(
    artist: DataFrame, album: DataFrame, track: DataFrame, line: DataFrame, limit: int = 10
) -> DataFrame:
    summary = artist_sales_summary(artist, album, track, line).select(
        F.col("ArtistId").alias("artist_id"),
        "artist_name",
        "total_albums",
        "total_tracks",
        "total_revenue",
        "avg_track_price",
    )
    return top_by(summary, "total_revenue", "artist_id", limit)


def purchase_history(
    customer_id: int,
    invoice: DataFrame,
    line: DataFrame,
    track: DataFrame,
    album: DataFrame,
    artist: DataFrame,
) -> DataFrame:
    """All purchased lines of one customer, newest invoice first."""
    mine = invoice.filter(F.col("CustomerId") == customer_id).select("InvoiceId", "InvoiceDate")
    # One customer's lines come first: each later join meets only their tracks, albums and artists.
    return (
        line.join(mine, "InvoiceId")
        .join(track.select("TrackId", "AlbumId", F.col("Name").alias("track_name")), "TrackId")
        .join(album.select("AlbumId", "ArtistId"), "AlbumId")
        .join(artist.select("ArtistId", F.col("Name").alias("artist_name")), "ArtistId")
        .orderBy(F.desc_nulls_first("InvoiceDate"), "InvoiceId", "InvoiceLineId", "TrackId")
        .select(
            F.col("InvoiceId").alias("invoice_id"),
            F.col("InvoiceDate").alias("invoice_date"),
            "track_name",
            "artist_name",
            F.col("UnitPrice").alias("unit_price"),
            F.col("Quantity").alias("quantity"),
            line_amount().alias("line_total"),
        )
    )


def monthly_revenue(invoice: DataFrame, year: int, padded: bool = False) -> DataFrame:
    """Revenue per month of a year. The year is a half-open date range, which the scan can use."""
    first, next_first = (F.lit(f"{y:04d}-01-01").cast("timestamp_ntz") for y in (year, year + 1))
    in_year = (F.col("InvoiceDate") >= first) & (F.col("InvoiceDate") < next_first)
    name = F.date_format(F.make_date(F.lit(year), F.col("month_num"), F.lit(1)), "MMMM")
    if padded:
        name = F.rpad(name, 9, " ")
    per_customer = (
        invoice.filter(in_year)
        .groupBy(F.month("InvoiceDate").alias("month_num"), "CustomerId")
        .agg(F.count("*").alias("orders"), F.sum("Total").cast(MONEY).alias("spent"), F.count("Total").alias("priced"))
    )
    return (
        per_customer.groupBy("month_num")
        .agg(
            F.sum("orders").alias("order_count"),
            F.sum("spent").cast(MONEY).alias("total_revenue"),
            F.sum("priced").alias("priced"),
            F.count("CustomerId").alias("unique_customers"),
        )
        .select(
            "month_num",
            name.alias("month_name"),
            "order_count",
            "total_revenue",
            average(F.col("total_revenue"), F.col("priced")).cast("decimal(18,2)").alias("avg_order_value"),
            "unique_customers",
        )
        .orderBy("month_num")
    )


def artist_revenue(
    artist: DataFrame, album: DataFrame, track: DataFrame, line: DataFrame, limit: int = 10
) -> DataFrame:
    """Top artists by revenue among those with sales; only sold tracks and their albums count."""
    sold = artist_measures(artist, album, track, line, "inner").select(
        "ArtistId", "artist_name", F.col("total_albums").alias("albums"), "revenue"
    )
    return sold.orderBy(F.desc_nulls_first("revenue"), "ArtistId").limit(limit).drop("ArtistId")


def artist_revenue_all(
    artist: DataFrame, album: DataFrame, track: DataFrame, line: DataFrame, limit: int = 10
) -> DataFrame:
    """The direct form of the stored summary's top list: artists without sales count with zero."""
    return top_by(artist_sales_summary(artist, album, track, line), "total_revenue", "ArtistId", limit).select(
        "artist_name", "total_albums", "total_revenue"
    )


def monthly_sales(invoice: DataFrame, first: str, last: str) -> DataFrame:
    """Sales per month between two timestamps, both included: a bare end date means its midnight."""
    stamp = F.col("InvoiceDate")
    inside = stamp.between(F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz"))
    return (
        invoice.filter(inside)
        .groupBy(F.trunc(stamp.cast("date"), "month").cast("timestamp_ntz").alias("month"))  # no time zone involved
        .agg(F.count("*").alias("order_count"), F.sum("Total").cast(MONEY).alias("total_revenue"))
        .orderBy("month")
    )


def sales_by_country(customer: DataFrame, invoice: DataFrame) -> DataFrame:
    spent = invoice.groupBy("CustomerId").agg(
        F.sum("Total").cast(MONEY).alias("spent"), F.count("Total").alias("priced")
    )
    return (
        customer.select("CustomerId", "Country")
        .join(spent, "CustomerId")
        .groupBy("Country")
        .agg(
            F.count("CustomerId").alias("customer_count"),
            F.sum("spent").cast(MONEY).alias("total_revenue"),
            F.sum("priced").alias("priced"),
        )
        .withColumn(
            "avg_order_value", F.col("total_revenue") / F.nullif(F.col("priced"), F.lit(0)).cast("decimal(12,0)")
        )
        .orderBy(F.desc_nulls_first("total_revenue"), "Country")
        .select("Country", "customer_count", "total_revenue", "avg_order_value")
    )


def genre_performance(genre: DataFrame, track: DataFrame, album: DataFrame, line: DataFrame) -> DataFrame:
    """``tracks`` counts joined rows: a track appears once per sold line, once if unsold."""
    return (
        genre_measures(genre, track, album, line, "inner")
        .orderBy(F.desc_nulls_last("units"), "GenreId")
        .select(
            F.col("genre_name").alias("genre"),
            F.col("joined_rows").alias("tracks"),
            F.col("album_count").alias("albums"),
            F.col("units").alias("units_sold"),
        )
    )


def genre_track_counts(genre: DataFrame, track: DataFrame) -> DataFrame:
    counts = track.groupBy("GenreId").agg(F.count("TrackId").alias("track_count"))
    return genre.join(counts, "GenreId").select("Name", "track_count")


def album_details(album_id, album: DataFrame, track: DataFrame, artist: DataFrame) -> DataFrame:
    """One row per track of an album: nothing is collected, whatever the album's length."""
    return (
        track.filter(F.col("AlbumId") == album_id)
        .select("TrackId", F.col("Name").alias("track_name"), "AlbumId")
        .join(album.filter(F.col("AlbumId") == album_id), "AlbumId")
        .join(artist.select("ArtistId", F.col("Name").alias("artist_name")), "ArtistId")
        .orderBy("TrackId")
        .select("AlbumId", F.col("Title").alias("album_title"), "artist_name", "TrackId", "track_name")
    )


def search_tracks(track: DataFrame, query: str) -> DataFrame:
    """Tracks whose name has every word of the query, in any case and anywhere."""
    found = track
    for word in query.lower().split():
        found = found.filter(F.lower("Name").contains(word))
    return found.select("TrackId", F.col("Name").alias("track_name")).orderBy("TrackId")

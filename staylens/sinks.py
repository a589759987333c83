"""Writers: tables, exports and reports as files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions.text import strip
from staylens.functions.urls import page_key
from staylens.operators import reviews as R
from staylens.operators import stats as S


#: Rows of a file of CSV. Values may hold line breaks, so a file is read whole by one task.
CSV_ROWS = 500_000


def write_csv(df: DataFrame, path: str, most: int = CSV_ROWS) -> None:
    """CSV with a head, ``most`` rows a file."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("maxRecordsPerFile", most).csv(path)


def write_sheets(sheets: dict[str, DataFrame], path: str) -> None:
    """One folder of CSV for each sheet of a report."""
    for name, df in sheets.items():
        write_csv(df, f"{path}/{name}")


def province_report(df: DataFrame, k: int = 15) -> dict[str, DataFrame]:
    """Data, the top provinces, all provinces, and a summary row."""
    return {
        "Data": df,
        "Top_Provinces": S.top_frequency(df, "province", k),
        "All_Provinces": S.frequency(df, "province"),
        "Summary": df.agg(
            F.count(F.lit(1)).alias("reviews"), F.count_distinct("province").alias("provinces"), F.avg(F.col("is_vietnamese").cast("int")).alias("vietnamese_share")
        ),
    }


def encodings(df: DataFrame) -> dict[str, DataFrame]:
    """(label, id) of rooms, groups and stays."""
    return {
        "room_type": R.label_codes(df, "room_type").orderBy("id"),
        "group_type": R.label_codes(df, "group_type").orderBy("id"),
        "stay_duration": R.stay_codes(df, "stay_duration").orderBy("id"),
    }


def write_json(df: DataFrame, path: str) -> None:
    """Rows as JSON lines; a one-row aggregate thus is a report."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def dataset_description(df: DataFrame, columns: tuple[str, ...], numeric: tuple[str, ...], keys: tuple[str, ...]) -> dict[str, DataFrame]:
    """Sheets that describe a table: null counts, figures, and the shares of each key's values."""
    return {"nulls": S.null_counts(df, columns), "numbers": S.describe(df, numeric)} | {f"by_{k}": S.share_of_all(df, k) for k in keys}


def processing_report(df: DataFrame, least: float = 5) -> DataFrame:
    """One row: rows, kept, low, unscored, and the kept share in percent (null for an empty table)."""
    found = R.score_funnel(df, least)
    return found.withColumn("kept_percent", F.try_divide(F.col("kept") * 100, F.col("total")))


def write_learning_text(df: DataFrame, text: str, label: str, path: str) -> None:
    """label, tab, text in one line each, so that both stay aligned; blank texts are left out."""
    line = F.concat_ws("\t", F.format_string("%s", F.regexp_replace(F.col(label).cast("string"), r"\.0$", "")), F.regexp_replace(strip(F.col(text)), r"\s+", " "))
    df.filter(F.col(text).isNotNull() & (strip(F.col(text)) != "")).select(line.alias("value")).write.mode("overwrite").text(path)


def write_links(links: DataFrame, path: str) -> None:
    """Sorted urls in a folder for each province."""
    links.repartition("province").sortWithinPartitions("province", "url").select("province", F.col("url").alias("value")).write.mode("overwrite").partitionBy("province").text(path)


def append_failed(urls: DataFrame, path: str) -> None:
    urls.select(F.col("url").alias("value")).write.mode("append").text(path)


def write_hotels(hotels: DataFrame, path: str) -> None:
    """Hotel documents as JSON in a folder for each province, with their file key."""
    hotels.withColumn("key", page_key(F.col("url"))).write.mode("overwrite").partitionBy("province").json(path)


def write_bad_files(bad: DataFrame, path: str) -> None:
    """Unreadable documents (path, content)."""
    bad.write.mode("overwrite").parquet(path)

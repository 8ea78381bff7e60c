"""Scans of landed documents, listings, nested configs and delimited lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.text import collapse_ws, strip_tags
from ..operators.ordered import first_per_key

# Smallest admissible body, in bytes, of a release page and of an article.
RELEASE_MIN_BYTES = 20_000
ARTICLE_MIN_BYTES = 5_000


class Tables:
    """Parquet tables of one folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        df = self._spark.read.parquet(f"{self._folder}/{name}.parquet")
        setattr(self, name, df)
        return df


def scan_files(spark: SparkSession, path: str, glob: str = "*.html") -> DataFrame:
    """Landed pages of a folder; the id is the file stem."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select(
        F.regexp_extract("path", r"([^/]+?)(?:\.[^./]+)?$", 1).alias("doc_id"),
        F.col("content").cast("string").alias("html"),
        F.col("length").alias("n_bytes"),
        F.col("modificationTime").alias("retrieved_at"),
    )


def admissibility(df: DataFrame, body: str, min_bytes: int, http_status: Column | None = None) -> DataFrame:
    """Mark each body ok or not, with a note; both branches are kept."""
    big = F.octet_length(body) > min_bytes
    status_ok = (http_status == 200) if http_status is not None else F.lit(True)
    ok = F.coalesce(big & status_ok, F.lit(False))
    return df.withColumn("ok", ok).withColumn("note", F.when(~ok, F.lit("inadmissible_response")))


def listing_items(
    df: DataFrame, page_key: Sequence[str], html: str, pattern: str, per: Sequence[str] = ()
) -> DataFrame:
    """(id, title) pairs of list pages; the first title of an id wins, whatever its length and the tags in it.

    `pattern` has two groups, id and title. `per` are the columns within which
    an id is unique (default: one page).
    """
    ids = F.regexp_extract_all(html, F.lit(pattern), F.lit(1))
    titles = F.regexp_extract_all(html, F.lit(pattern), F.lit(2))
    items = df.select(*page_key, F.posexplode(F.arrays_zip(ids.alias("id"), titles.alias("title"))).alias("pos", "item"))
    flat = items.select(*page_key, "pos", F.col("item.id").alias("id"), collapse_ws(strip_tags(F.col("item.title"))).alias("title"))
    scope = list(per) or list(page_key)
    return first_per_key(flat, [*scope, "id"], [*[F.col(k) for k in page_key], F.col("pos")])


def titled_periods(df: DataFrame, title: str, families: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows whose title matches a document family, with the month the title names.

    Each family is (name, pattern); groups 1 and 2 are regional year and month.
    """
    name, y, m = F.lit(None).cast("string"), F.lit(""), F.lit("")
    for fam, pattern in reversed(list(families)):
        hit = F.col(title).rlike(pattern)
        name = F.when(hit, F.lit(fam)).otherwise(name)
        y = F.when(hit, F.regexp_extract(title, pattern, 1)).otherwise(y)
        m = F.when(hit, F.regexp_extract(title, pattern, 2)).otherwise(m)
    return (
        df.withColumn("family", name)
        .filter(F.col("family").isNotNull())
        .withColumn("reference_month", cal.roc_month(y.try_cast("int"), m.try_cast("int")))
    )


CONFIG_SCHEMA = (
    "rows array<struct<obs_month:date,reported_by:string,note:string,sources:array<struct<"
    "url:string,published:date,outlet:string,quote:string,fields:map<string,string>>>>>"
)


def read_figure_config(spark: SparkSession, path: str) -> DataFrame:
    """Curated figures: one row per month with its ordered sources."""
    doc = spark.read.schema(CONFIG_SCHEMA).json(path, multiLine=True)
    return doc.select(F.explode("rows").alias("r")).select("r.*")


def config_sources(config: DataFrame) -> DataFrame:
    return config.select("obs_month", "reported_by", "note", F.posexplode("sources").alias("source_no", "s")).select(
        "obs_month", "reported_by", "note", "source_no", "s.*"
    )


def config_fields(config: DataFrame) -> DataFrame:
    """One row per (month, source, field) with the value as printed."""
    s = config_sources(config)
    return s.select("obs_month", "source_no", "url", "published", F.explode("fields").alias("field", "printed"))


def read_source_list(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Tab-separated source list: (rows, malformed lines).

    `#` lines and blank lines are skipped, a row needs three fields, the last
    two are optional.
    """
    lines = spark.read.text(path).filter((F.trim("value") != "") & ~F.trim("value").startswith("#"))
    parts = lines.withColumn("p", F.split("value", "\t"))
    good = parts.filter(F.size("p") >= 3)

    def cell(i: int) -> Column:
        return F.trim(F.get("p", i))

    rows = good.select(
        cell(0).alias("host"),
        cell(1).try_cast("int").alias("tier"),
        cell(2).alias("url"),
        cell(3).try_cast("int").alias("expect"),
        F.coalesce(cell(4), F.lit("")).alias("note"),
    )
    return rows, parts.filter(F.size("p") < 3).select("value")


def status_expected(status: Column, expect: Column) -> Column:
    """The expected status where one is set, else any success or redirect."""
    return F.when(expect.isNotNull(), status == expect).otherwise((status >= 200) & (status < 400))


def read_line_items(spark: SparkSession, path: str, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Wide line-item CSV to long rows (keys, line_code, value)."""
    schema = ", ".join([*(f"{k} string" for k in keys), *(f"{m} decimal(20,4)" for m in measures)])
    return to_long(spark.read.schema(schema).csv(path, header=True), keys, measures)


def to_long(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    return df.unpivot(list(keys), list(measures), "line_code", "value").filter("value IS NOT NULL")


def to_wide(df: DataFrame, keys: Sequence[str], measures: Sequence[str], value: str = "value") -> DataFrame:
    return df.groupBy(*keys).pivot("line_code", list(measures)).agg(F.first(value, ignorenulls=True))

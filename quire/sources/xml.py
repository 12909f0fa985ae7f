"""Book metadata in ONIX-like XML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Declared, because inference reads identifiers as numbers and drops their leading zeros. What the standard
# lets repeat is an array.
PRODUCT_SCHEMA = """
    RecordReference string,
    ProductIdentifier array<struct<ProductIDType: string, IDValue: string>>,
    DescriptiveDetail struct<
        TitleDetail: array<struct<TitleType: string, TitleElement: array<struct<TitleText: string, Subtitle: string>>>>,
        Contributor: array<struct<SequenceNumber: string, ContributorRole: array<string>, PersonName: string>>,
        Language: array<struct<LanguageRole: string, LanguageCode: string>>>,
    PublishingDetail struct<
        Publisher: array<struct<PublishingRole: string, PublisherName: string>>,
        PublishingDate: array<struct<PublishingDateRole: string, Date: string>>>,
    ProductSupply array<struct<SupplyDetail: array<struct<
        Price: array<struct<PriceType: string, PriceAmount: string, CurrencyCode: string>>>>>>
"""

# Products of a written file: some tens of megabytes.
FILE_PRODUCTS = 50_000

# Identifier types of the standard.
ISBN10_TYPE = "02"
ISBN13_TYPE = "15"
DISTINCTIVE_TITLE = "01"


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """Raw products, one row per Product element, nested as delivered."""
    return (
        spark.read.format("xml")
        .option("rowTag", "Product")
        .option("mode", "FAILFAST")
        .schema(PRODUCT_SCHEMA)
        .load(path)
    )


def write_products(products: DataFrame, path: str, mode: str = "error") -> None:
    """Products as XML files of bounded size: a file is read by one task, as its records cannot be found from the middle."""
    rows = products.hint("rebalance")
    rows.write.mode(mode).format("xml").option("rowTag", "Product").option("rootTag", "ONIXMessage").option("maxRecordsPerFile", FILE_PRODUCTS).save(path)


def product_identifiers(products: DataFrame) -> DataFrame:
    """Reference, ISBN-13, ISBN-10 and title of each product: the distinctive title, else the first one."""

    def identifier(kind: str):
        matches = F.filter("ProductIdentifier", lambda i: i["ProductIDType"] == kind)
        return F.get(matches, 0)["IDValue"]

    return products.select(
        F.col("RecordReference").alias("reference"),
        identifier(ISBN13_TYPE).alias("isbn13"),
        identifier(ISBN10_TYPE).alias("isbn10"),
        _title("DescriptiveDetail.TitleDetail").alias("titre"),
    )


def _title(details: str) -> Column:
    distinctive = F.filter(details, lambda d: d["TitleType"] == DISTINCTIVE_TITLE)
    first = F.coalesce(F.get(distinctive, 0), F.get(details, 0))
    return F.get(first["TitleElement"], 0)["TitleText"]


def product_contributors(products: DataFrame) -> DataFrame:
    """One row per product, contributor and role, in the order of the record."""
    each = products.select(
        F.col("RecordReference").alias("reference"), F.posexplode("DescriptiveDetail.Contributor").alias("place", "c")
    )
    return each.select("reference", (F.col("place") + 1).alias("ordre"), F.explode("c.ContributorRole").alias("role"), F.col("c.PersonName").alias("nom"))

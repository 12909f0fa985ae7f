"""Source-shaped tables derived from a generic star schema (orders, lines, parts, parties, events).

Lines play the sales and the stock positions, parts the books, suppliers the publishers and warehouses,
customers the authors, orders the orders and contracts. The derivation plants the flaws that cleaning
is about: wrong check digits, impossible dates, blank pseudonyms, returns, repeated movement numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import date_to_cyymmdd, isbn13_check_digit
from quire.functions.codes import label
from quire.operators.clean import computed_once

# How the star schema's codes read as the model's.
CHANNELS = {1: "LIB", 2: "GMS", 3: "WEB", 4: "EXP", 5: "CLB"}
FORMATS = {"STANDARD": "GFT", "SMALL": "POC", "MEDIUM": "NUM", "LARGE": "AUD", "PROMO": "BDA"}
STATUSES = {0: "AC", 1: "EP", 2: "AN", 3: "PI", 4: "RS"}
MOVEMENTS = {"N": "V", "R": "R", "A": "A"}
ORDER_STATUSES = {"F": "LV", "O": "EN", "P": "PA"}
ROLES = {"1-URGENT": "AUT", "2-HIGH": "TRA", "3-MEDIUM": "ILL", "4-NOT SPECIFIED": "PRE", "5-LOW": "AUT"}
RATES = {"1-URGENT": "8.00", "2-HIGH": "12.00", "3-MEDIUM": "10.00", "4-NOT SPECIFIED": "6.00", "5-LOW": "3.00"}
UNKNOWN = "XXX"

BAD_ISBN_EVERY = 97
EMPTY_DATE_EVERY = 211
WRONG_MONTH_EVERY = 503
SETTLEMENT_DAYS = 31


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def isbn_of(part: str) -> Column:
    """A 13-digit number from a part key; one part in 97 gets a wrong check digit."""
    twelve = f"({part} + {978 * 10**9}L)"
    check = isbn13_check_digit(twelve) + F.expr(f"int({part} % {BAD_ISBN_EVERY} = 0)")
    return (F.expr(twelve) * 10 + check % 10).cast("string")


def code_of(prefix: str, key: Column, width: int = 9) -> Column:
    return F.concat(F.lit(prefix), F.lpad(key.cast("string"), width, "0"))


def money(value: Column, precision: int = 11) -> Column:
    return value.cast(f"decimal({precision},2)")


def sales(spark: SparkSession, folder: str) -> DataFrame:
    settled = date_to_cyymmdd(f"date_add(date(l_shipdate), {SETTLEMENT_DAYS})")
    line = computed_once(
        read(spark, folder, "lineitem"),
        _isbn=isbn_of("l_partkey"),
        _sold=date_to_cyymmdd("date(l_shipdate)"),
        _settled=F.when(F.col("l_returnflag") == "N", settled),
    )
    back = F.col("l_returnflag") == "R"
    net = money(F.col("l_extendedprice"))
    gross = money(net * (F.lit(1) + F.col("l_tax").cast("decimal(5,2)")))
    return line.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("VENUMR"),
        F.col("_isbn").alias("VEISBN"),
        F.col("_sold").alias("VEDTVT"),
        (F.col("l_quantity").cast("int") * F.when(back, -1).otherwise(1)).alias("VEQTE"),
        # Negated, not multiplied: a product of decimals is made of big numbers, several times slower.
        F.when(back, -net).otherwise(net).alias("VEMTHT"),
        F.when(back, -gross).otherwise(gross).alias("VEMTTTC"),
        label("l_linenumber", CHANNELS, UNKNOWN).alias("VECANL"),
        F.concat(code_of("P", F.col("l_suppkey"), 6), F.lit("   ")).alias("VECLIE"),
        code_of("W", F.col("l_suppkey")).alias("VEENTR"),
        F.col("_settled").alias("VEDTRG"),
        label("l_returnflag", MOVEMENTS, UNKNOWN).alias("VESTAT"),
    )


def books(spark: SparkSession, folder: str) -> DataFrame:
    part = computed_once(read(spark, folder, "part"), _isbn=isbn_of("p_partkey"))
    key = F.col("p_partkey")
    price = (F.col("p_retailprice").cast("decimal(9,2)") - 900) / 3
    net = price.cast("decimal(9,2)")
    published = date_to_cyymmdd("date_add(DATE '1960-01-01', int(p_partkey * 7 % 25000))")
    flawed = (
        F.when(key % EMPTY_DATE_EVERY == 0, 0)
        .when(key % WRONG_MONTH_EVERY == 0, 1251301)
        .otherwise(published)
    )
    brand = F.regexp_extract("p_brand", "([0-9]+)", 1)
    return part.select(
        F.col("_isbn").alias("OVISBN"),
        F.rpad("p_name", 40, " ").alias("OVTITR"),
        F.lit(None).cast("string").alias("OVSTIT"),
        code_of("S", brand).alias("OVEDIT"),
        F.concat(F.lit("C"), brand, F.substring("p_type", 1, 3)).alias("OVCOLL"),
        label("p_type", FORMATS, "ECO").alias("OVFMT"),
        F.lit("FRE").alias("OVLANG"),
        (F.col("p_size") * 10).alias("OVNBPG"),
        net.alias("OVPXHT"),
        (net * F.lit("1.055").cast("decimal(4,3)")).cast("decimal(9,2)").alias("OVPXTTC"),
        F.lit("5.50").cast("decimal(5,2)").alias("OVTVA"),
        flawed.cast("int").alias("OVDTPB"),
        F.lit(1200101).alias("OVDTCR"),
        F.lit(1250101).alias("OVDTMJ"),
        label(F.col("p_size") % 5, STATUSES, UNKNOWN).alias("OVSTAT"),
        (F.col("p_size") * 1000).alias("OVTIRG"),
        (F.col("p_size") * 20).alias("OVPOID"),
        F.col("_isbn").alias("OVEAN"),
        F.col("p_brand").alias("OVCOMM"),
    )


def authors(spark: SparkSession, folder: str) -> DataFrame:
    party = read(spark, folder, "customer")
    balance = F.col("c_acctbal").cast("decimal(11,2)")
    key = F.col("c_custkey")
    born = date_to_cyymmdd("date_add(DATE '1930-01-01', int(c_custkey * 11 % 20000))")
    died = date_to_cyymmdd("date_add(DATE '1995-01-01', int(c_custkey * 3 % 9000))")
    pseudonym = (
        F.when(balance < 1000, F.lit("          "))
        .when(balance > 9000, F.concat(F.lit("Plume "), key.cast("string"), F.lit("   ")))
    )
    return party.select(
        code_of("A", key).alias("AUCODE"),
        F.rpad("c_name", 30, " ").alias("AUNOM"),
        F.rpad("c_mktsegment", 20, " ").alias("AUPRN"),
        pseudonym.alias("AUPSEUD"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("AUNATI"),
        born.alias("AUDTNS"),
        F.when(balance > 5000, died).alias("AUDTDC"),
        F.lit(None).cast("string").alias("AUEMAIL"),
        F.lit(1200101).alias("AUDTCR"),
        F.when(balance > 0, "A").otherwise("I").alias("AUSTAT"),
    )


def publishers(spark: SparkSession, folder: str) -> DataFrame:
    supplier = read(spark, folder, "supplier")
    name = F.rpad("s_name", 40, " ")
    nation = F.col("s_nationkey").cast("string")
    return supplier.select(
        code_of("S", F.col("s_suppkey")).alias("EDCODE"),
        name.alias("EDNOM"),
        name.alias("EDIMPR"),
        F.concat(F.lit("G"), nation).alias("EDGRPE"),
        F.lpad(nation, 2, "0").alias("EDPAYS"),
        F.when(F.col("s_acctbal").cast("decimal(11,2)") > 1000, "A").otherwise("I").alias("EDSTAT"),
    )


def collections(spark: SparkSession, folder: str) -> DataFrame:
    brand = F.regexp_extract("p_brand", "([0-9]+)", 1)
    pairs = read(spark, folder, "part").groupBy("p_brand", "p_type").agg(F.count("*").alias("_n"))
    return pairs.select(
        F.concat(F.lit("C"), brand, F.substring("p_type", 1, 3)).alias("CLCODE"),
        F.concat_ws(" ", "p_brand", "p_type", F.lit("  ")).alias("CLNOM"),
        code_of("S", brand).alias("CLEDIT"),
        F.lit(1200101).alias("CLDTCR"),
        F.lit("A").alias("CLSTAT"),
    )


def warehouses(spark: SparkSession, folder: str) -> DataFrame:
    towns = read(spark, folder, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return read(spark, folder, "supplier").join(towns, "s_nationkey", "left").select(
        code_of("W", F.col("s_suppkey")).alias("RECODE"),
        F.rpad("s_name", 40, " ").alias("RENOM"),
        F.col("n_name").alias("REVILL"),
    )


def channels(spark: SparkSession, folder: str) -> DataFrame:
    region = read(spark, folder, "region")
    return region.select(
        label(F.col("r_regionkey") + 1, CHANNELS, UNKNOWN).alias("RCCODE"),
        F.rpad("r_name", 40, " ").alias("RCLIB"),
    )


def _line_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Per order what its lines say: smallest part, ordered and delivered copies, last delivery."""
    sent = F.col("l_linestatus") == "F"
    quantity = F.col("l_quantity").cast("int")
    return read(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_partkey").alias("_part"),
        F.sum(quantity).alias("_ordered"),
        F.sum(F.when(sent, quantity)).alias("_sent"),
        F.max(F.when(sent, F.col("l_shipdate").cast("date"))).alias("_last"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    joined = read(spark, folder, "orders").join(_line_totals(spark, folder), "o_orderkey", "left")
    return joined.select(
        F.col("o_orderkey").alias("CMNUMR"),
        isbn_of("_part").alias("CMISBN"),
        date_to_cyymmdd("date(o_orderdate)").alias("CMDTCM"),
        date_to_cyymmdd("_last").alias("CMDTLV"),
        F.col("_ordered").cast("int").alias("CMQTE"),
        F.col("_sent").cast("int").alias("CMQTLV"),
        money(F.col("o_totalprice")).alias("CMMTHT"),
        code_of("A", F.col("o_custkey")).alias("CMCLIE"),
        label("o_orderstatus", ORDER_STATUSES, UNKNOWN).alias("CMSTAT"),
    )


def contracts(spark: SparkSession, folder: str) -> DataFrame:
    joined = read(spark, folder, "orders").join(_line_totals(spark, folder), "o_orderkey", "left")
    title = F.when(F.col("o_orderpriority") != "5-LOW", isbn_of("_part"))
    end = F.when(F.col("o_orderstatus") == "F", date_to_cyymmdd("date_add(date(o_orderdate), 1000)"))
    return joined.select(
        F.col("o_orderkey").alias("CTNUM"),
        code_of("A", F.col("o_custkey")).alias("CTAUTE"),
        title.alias("CTISBN"),
        F.lit("CES").alias("CTTYPE"),
        label("o_orderpriority", RATES, "0.00").cast("decimal(5,2)").alias("CTPCTD"),
        (money(F.col("o_totalprice")) / 100).cast("decimal(11,2)").alias("CTAVNC"),
        date_to_cyymmdd("date(o_orderdate)").alias("CTDTDB"),
        end.alias("CTDTFN"),
        F.when(F.col("o_orderstatus") == "F", "T").otherwise("A").alias("CTSTAT"),
    )


def book_authors(spark: SparkSession, folder: str) -> DataFrame:
    """Who ordered a part counts as one of its contributors."""
    line = read(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    order = read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", label("o_orderpriority", ROLES, UNKNOWN).alias("_role")
    )
    pairs = line.join(order, "l_orderkey").groupBy("l_partkey", "o_custkey", "_role").agg(
        F.min("l_linenumber").alias("_place")
    )
    return pairs.select(
        isbn_of("l_partkey").alias("JAISBN"),
        code_of("A", F.col("o_custkey")).alias("JAAUTE"),
        F.col("_role").alias("JAROLE"),
        F.col("_place").alias("JAORDR"),
    )


def stock(spark: SparkSession, folder: str) -> DataFrame:
    line = computed_once(
        read(spark, folder, "lineitem"),
        _isbn=isbn_of("l_partkey"),
        _day=date_to_cyymmdd("date(l_shipdate)"),
    )

    def cents(column: str) -> Column:
        return (F.col(column).cast("decimal(5,2)") * 100).cast("int")

    return line.select(
        F.col("_isbn").alias("SKISBN"),
        code_of("W", F.col("l_suppkey")).alias("SKENTR"),
        F.col("_day").alias("SKDTPS"),
        F.col("l_quantity").cast("int").alias("SKQTDS"),
        F.col("l_linenumber").alias("SKQTRS"),
        F.nullif(cents("l_discount"), F.lit(0)).alias("SKQTTR"),
        cents("l_tax").alias("SKQTPI"),
    )


def load_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as loads: the type is the table, the value the rows loaded."""
    return read(spark, folder, "events").select(
        F.col("event_type").alias("table_name"),
        F.col("ts").alias("loaded_at"),
        F.col("value").cast("decimal(18,2)").cast("bigint").alias("row_count"),
    )


SOURCES = {
    "ouvrages": books,
    "auteurs": authors,
    "ouvrages_auteurs": book_authors,
    "editeurs": publishers,
    "collections": collections,
    "ventes": sales,
    "commandes": orders,
    "stocks": stock,
    "contrats": contracts,
    "ref_canaux": channels,
    "ref_entrepots": warehouses,
}


def isbn10_of(part: str) -> Column:
    """A 10-character number from a part key, with X as check digit where due; wrong for one in 97."""
    weighted = " + ".join(f"{part} DIV {10**place}L % 10L * {place + 2}L" for place in range(9))
    check = F.expr(f"((11L - ({weighted}) % 11L) % 11L + int({part} % {BAD_ISBN_EVERY} = 0)) % 11L")
    last = F.when(check == 10, F.lit("X")).otherwise(check.cast("string"))
    return F.concat(F.lpad(F.col(part).cast("string"), 9, "0"), last)

"""Every operator as a query over the whole given tables: name to function of (session, folder)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import (
    contains_any,
    cyymmdd_to_date,
    date_to_cyymmdd,
    format_label,
    is_missing,
    isbn10_to_13,
    isbn13_has_shape,
    isbn13_valid,
    movement_label,
    normalise_isbn,
    price_band,
    status_label,
    strip_controls,
    trim_fixed,
    typed,
)
from quire.functions.dates import iso_date
from quire.functions.text import SEARCHED_IN_NAMES
from quire.model import table
from quire.operators.calendar import calendar_covering
from quire.operators.clean import clean_by_metadata, pad_fixed, to_raw
from quire.operators.clustering import cluster_by, files_holding
from quire.operators.drilldown import drill_down
from quire.operators.evolve import read_evolved
from quire.operators.dedupe import collapse_report, keep_latest, latest_with_ties
from quire.operators.joins import orphan_keys
from quire.operators.keys import key_collisions
from quire.operators.merge import snapshot_diff, union_evolved, upsert
from quire.operators.profile import exact_distinct, profile_columns
from quire.operators.vectors import CosineSearch, cosine_topk
from quire.plans import gate, gold, increments, measures, monitor, recon
from quire.plans.pipeline import Lake
from quire.plans.silver import excluded_rows, silver
from quire.session import scratch_folder, stored_once
from quire.sources import (
    high_water_mark,
    read_delimited,
    read_parquet,
    rows_since,
    slice_counts,
    write_delimited,
)
from quire.sources.quarantine import take_in
from quire.sources.sinks import overwrite, overwrite_clustered, overwrite_partitioned, overwrite_sorted, write_json
from quire.sources.slices import SlicedExtract
from quire.sources.xml import product_identifiers, read_products, write_products
from quire.streaming.drop_folder import load_drop_folder
from quire.streaming.onix import load_products, merge_batch, products, quarantined
from quire.trial import mapping

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the queries; the checking SQL uses the same.
FIRST_LOAD_END = dt.date(2001, 1, 1)
SECOND_LOAD_START = dt.date(2000, 6, 1)
SNAPSHOT_FROM, SNAPSHOT_TO = dt.date(1996, 1, 1), dt.date(2001, 1, 1)
AS_OF = dt.datetime(2024, 1, 30, 12, 0, 0)
WATCHED = ["click", "view", "purchase", "signup", "error", "fact_droits"]
REPORT_YEAR, REPORT_PUBLISHER = 1998, "S000000007"
EXTRACTED_AT = dt.datetime(2025, 3, 16, 6, 0)
COUNTED = ("ouvrages", "auteurs", "editeurs", "ventes", "commandes", "stocks", "contrats")
FILE_FILTER = {"l_shipdate": (dt.datetime(1998, 1, 1), dt.datetime(1998, 12, 31))}
FIRST_DELIVERY_END = 990_101
EARLIER_CENT = 7


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


class Tables:
    """The mapped tables in their three layers, built when asked for and then kept."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.built: dict[tuple[str, str], DataFrame] = {}

    def _kept(self, layer: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if (layer, name) not in self.built:
            self.built[layer, name] = build()
        return self.built[layer, name]

    def given(self, name: str) -> DataFrame:
        return mapping.read(self.spark, self.folder, name)

    def bronze(self, name: str) -> DataFrame:
        return self._kept("bronze", name, lambda: mapping.SOURCES[name](self.spark, self.folder))

    def silver(self, name: str) -> DataFrame:
        return self._kept("silver", name, lambda: silver(name, self.bronze(name)))

    def gold(self, name: str) -> DataFrame:
        builders = {
            "ouvrages": lambda: gold.dim_book(self.silver("ouvrages")),
            "auteurs": lambda: gold.dim_author(self.silver("auteurs")),
            "editeurs": lambda: gold.dim_publisher(self.silver("editeurs")),
            "ventes": lambda: gold.fact_sales(self.silver("ventes")),
            "stocks": lambda: gold.fact_stock(
                self.silver("stocks"), self.silver("ouvrages").filter("isbn_valide")
            ),
        }
        return self._kept("gold", name, builders[name])

    @property
    def bridge(self) -> DataFrame:
        return self.silver("ouvrages_auteurs")

    @property
    def fact_sales(self) -> DataFrame:
        return self.gold("ventes")

    @property
    def dim_book(self) -> DataFrame:
        return self.gold("ouvrages")

    @property
    def dim_author(self) -> DataFrame:
        return self.gold("auteurs")

    @property
    def dim_publisher(self) -> DataFrame:
        return self.gold("editeurs")


# Sources, loading and sinks ----------------------------------------------------------------------


@query
def bronze_typed(spark, folder):
    return to_raw(Tables(spark, folder).bronze("ventes"), table("ventes"))


@query
def csv_bronze_roundtrip(spark, folder):
    raw = to_raw(Tables(spark, folder).bronze("ventes"), table("ventes"))
    path = scratch_folder(spark, "ventes-csv")
    write_delimited(raw, path)
    return read_delimited(spark, path, table("ventes").schema)


@query
def bronze_copy(spark, folder):
    copied = read_parquet(spark, f"{folder}/orders.parquet")
    return copied.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


@query
def extract_orders(spark, folder):
    return Tables(spark, folder).bronze("commandes").select(table("commandes").source_columns)


@query
def incremental_since(spark, folder):
    source = Tables(spark, folder).given("orders")
    loaded = source.filter(F.col("o_orderdate") < F.lit(FIRST_LOAD_END))
    mark = high_water_mark(loaded, "o_orderdate")
    fresh = rows_since(source, "o_orderdate", mark)
    return fresh.select("o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderstatus")


def _orders_priced(tables: Tables) -> DataFrame:
    return tables.given("orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.col("o_totalprice").cast("decimal(11,2)").alias("o_totalprice"),
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
    )


@query
def upsert_by_key(spark, folder):
    orders = _orders_priced(Tables(spark, folder))
    target = orders.filter(F.col("o_orderdate") < F.lit(FIRST_LOAD_END))
    batch = orders.filter(F.col("o_orderdate") >= F.lit(SECOND_LOAD_START)).withColumn(
        "o_orderstatus", F.lit("X")
    )
    return upsert(target, batch, ["o_orderkey"], ("o_orderdate",))


@query
def snapshot_diff_orders(spark, folder):
    orders = _orders_priced(Tables(spark, folder))
    old = orders.filter(F.col("o_orderdate") < F.lit(SNAPSHOT_TO))
    reopened = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 100000)
    new = orders.filter(F.col("o_orderdate") >= F.lit(SNAPSHOT_FROM)).withColumn(
        "o_orderstatus", F.when(~reopened, F.col("o_orderstatus"))
    )
    return snapshot_diff(old, new, ["o_orderkey"])


@query
def slice_counts_by_year(spark, folder):
    sales = Tables(spark, folder).silver("ventes")
    return slice_counts(sales.withColumn("annee", F.year("date_vente")), "annee", "code_entrepot")


@query
def union_evolved_schema(spark, folder):
    orders = Tables(spark, folder).given("orders")
    before = orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus")
    after = orders.filter("o_orderstatus <> 'F'").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return union_evolved(before, after)


@query
def bronze_manifest(spark, folder):
    t = Tables(spark, folder)
    return recon.manifest({n: t.bronze(n) for n in COUNTED}, EXTRACTED_AT)


@query
def table_inventory(spark, folder):
    t = Tables(spark, folder)
    return recon.inventory({n: t.bronze(n) for n in COUNTED})


@query
def column_profile(spark, folder):
    orders = to_raw(Tables(spark, folder).bronze("commandes"), table("commandes"))
    return profile_columns(orders, "CMDEP", approx_distinct=False)


@query
def column_profile_sketched(spark, folder):
    sales = to_raw(Tables(spark, folder).bronze("ventes"), table("ventes"))
    return profile_columns(sales, "VENTEP")


# Written and read back ---------------------------------------------------------------------------


@query
def extract_authors(spark, folder):
    return Tables(spark, folder).bronze("auteurs").select(table("auteurs").source_columns)


@query
def extract_publishers(spark, folder):
    return Tables(spark, folder).bronze("editeurs").select(table("editeurs").source_columns)


@query
def extract_contracts(spark, folder):
    return Tables(spark, folder).bronze("contrats").select(table("contrats").source_columns)


@query
def extract_books(spark, folder):
    return Tables(spark, folder).bronze("ouvrages").select(table("ouvrages").source_columns)


@query
def observed_manifest(spark, folder):
    """Rows counted while bronze is written: no table is read for its manifest."""
    t, lake = Tables(spark, folder), Lake(spark, scratch_folder(spark, "observed"))
    for n in COUNTED:
        lake.store_raw(n, t.bronze(n))
    return recon.counted_manifest(spark, {n: lake.seen["bronze", n]["_rows"] for n in COUNTED}, EXTRACTED_AT)


@query
def observed_unreadable(spark, folder):
    """Values that bronze could not take over, counted in the same read: prices in words, a month of thirteen."""
    lake = Lake(spark, scratch_folder(spark, "unreadable"))
    books = Tables(spark, folder).bronze("ouvrages")
    delivered = books.withColumn("OVPXHT", F.when(F.col("OVNBPG") == 10, F.lit("dix")).otherwise(F.col("OVPXHT").cast("string")))
    lake.store_raw("ouvrages", delivered)
    return lake.unreadable("ouvrages")


def _first_delivery(sales: DataFrame) -> DataFrame:
    """What an earlier run had seen: sales up to a day, and some later ones that were then entered two years before, for nothing."""
    early, moved = F.col("VEDTVT") < FIRST_DELIVERY_END, F.col("VENUMR") % 20 == EARLIER_CENT
    nothing = F.lit(0).cast("decimal(11,2)")
    entered = {"VEDTVT": (F.col("VEDTVT") - 20_000).cast("int"), "VEQTE": F.lit(0), "VEMTHT": nothing, "VEMTTTC": nothing}
    # One pass over the sales.
    chosen = sales.where(early | (moved & (F.col("VEDTVT") - 20_000 < FIRST_DELIVERY_END)))
    return chosen.withColumns({c: F.when(early, F.col(c)).otherwise(value) for c, value in entered.items()})


@query
def incremental_runs(spark, folder):
    """Two runs, the second of what changed since the first: rows come, and rows move to another year; the fact is that of one full run."""
    t, root = Tables(spark, folder), scratch_folder(spark, "increments")
    books = to_raw(t.bronze("ouvrages"), table("ouvrages"))
    # A later delivery replaces the rows of its keys, so the source has a row for each key.
    sales = stored_once(keep_latest(to_raw(t.bronze("ventes"), table("ventes")), ["VENUMR"], ("VEDTVT",)), "sales-source")
    increments.run(spark, {"ouvrages": books, "ventes": _first_delivery(sales)}, root, EXTRACTED_AT)
    increments.run(spark, {"ouvrages": books, "ventes": sales}, root, EXTRACTED_AT)
    return increments.read(spark, root, "gold", "fact_ventes")


@query
def sliced_extraction(spark, folder):
    """Sales by year and channel, in two runs: the second reads what the first has left, a third nothing."""
    source = stored_once(to_raw(Tables(spark, folder).bronze("ventes"), table("ventes")), "slice-source")
    yearly = source.withColumn("annee", F.floor(F.col("VEDTVT") / 10_000).cast("int"))
    extract = SlicedExtract(spark, scratch_folder(spark, "slices"), ["annee", "VECANL"])
    first = extract.run(yearly, together=8, groups=2)
    second = extract.run(yearly, together=64)
    third = extract.run(yearly)
    if set(first) & set(second) or third:
        raise AssertionError(f"slices were read again: {sorted(set(first) & set(second))}, {third}")
    return extract.table(yearly).drop("annee")


@query
def table_sizes(spark, folder):
    given = {n: Tables(spark, folder).given(n) for n in ("lineitem", "orders", "part", "customer", "supplier", "nation")}
    return recon.file_inventory(given)


@query
def merged_sketches(spark, folder):
    """Distinct values of sales from sketches of each year's load, merged, against counting all rows: 5 % is three standard errors."""
    sales, place = stored_once(to_raw(Tables(spark, folder).bronze("ventes"), table("ventes")), "sketch-source"), scratch_folder(spark, "sketches")
    columns = ["VEISBN", "VENUMR", "VEDTVT", "VECANL", "VEENTR"]
    for year in range(92, 103):
        load = sales.where((F.col("VEDTVT") >= year * 10_000) & (F.col("VEDTVT") < (year + 1) * 10_000))
        recon.distinct_sketches(load, str(1900 + year), columns).write.mode("append").parquet(place)
    loads = spark.read.parquet(place)
    merged = recon.merged_distinct(loads.where("row_count > 0"))
    exact = exact_distinct(sales.select(columns))
    near = F.abs(F.col("approx_distinct") - F.col("exact")) <= F.greatest(F.col("exact") * 0.05, F.lit(1))
    return merged.join(exact, "column_name").select("column_name", "row_count", near.alias("within_bound"))


@query
def evolved_deliveries(spark, folder):
    """Three deliveries of orders: a longer key and an old name in the second, more digits and a new column in the third."""
    priced = _orders_priced(Tables(spark, folder))
    price = F.col("o_totalprice")
    parts = {
        "one": priced.where("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("int").alias("o_orderkey"), F.col("o_orderdate").alias("day"), price),
        "two": priced.where("o_orderstatus = 'O'").select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), F.col("o_orderdate"), price),
        "three": priced.where("o_orderstatus = 'P'").select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_orderdate", price.cast("decimal(14,3)").alias("o_totalprice"), "o_orderstatus"),
    }
    stored = {name: stored_once(df, f"delivery-{name}") for name, df in parts.items()}
    return read_evolved(stored, renames={"day": "o_orderdate"})


@query
def quarantined_lines(spark, folder):
    """Orders as text with planted lines that do not fit: the accepted rows, beside what the line count says."""
    raw, place = to_raw(Tables(spark, folder).bronze("commandes"), table("commandes")), scratch_folder(spark, "quarantine")
    text = raw.select([F.col(f.source).cast("string").alias(f.source) for f in table("commandes").fields])
    flawed = text.withColumn("CMMTHT", F.when(F.col("CMNUMR") % 10 == 3, F.lit("12,50 EUR")).otherwise(F.col("CMMTHT")))
    write_delimited(flawed, place)
    intake = take_in(spark, place, table("commandes"))
    balance = intake.lines.agg(F.sum("lines").alias("lines"), F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"), F.bool_and("balanced").alias("balanced"))
    amount = intake.accepted.agg(measures.total("CMMTHT").alias("montant_ht"))
    return balance.join(F.broadcast(amount), F.lit(True))


@query
def drill_down_orders(spark, folder):
    """Exactly the rows that differ between two copies of the orders."""
    old = stored_once(_orders_priced(Tables(spark, folder)), "drill-old")
    key = F.col("o_orderkey")
    new = old.where(key % 997 != 5).withColumn("o_totalprice", F.when(key % 1009 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).cast("decimal(11,2)"))
    return drill_down(old, stored_once(new, "drill-new"), "o_orderkey")


@query
def sorted_load(spark, folder):
    path = scratch_folder(spark, "sorted")
    overwrite_sorted(_orders_priced(Tables(spark, folder)), path, "o_orderkey")
    return read_parquet(spark, path)


@query
def overwrite_new_schema(spark, folder):
    """A table replaced by one with more columns."""
    priced, path = _orders_priced(Tables(spark, folder)), scratch_folder(spark, "replaced")
    overwrite(priced.select("o_orderkey", "o_orderstatus"), path)
    overwrite(priced, path)
    return read_parquet(spark, path)


@query
def partitioned_write(spark, folder):
    path = scratch_folder(spark, "by-year")
    yearly = _orders_priced(Tables(spark, folder)).withColumn("o_year", F.year("o_orderdate"))
    overwrite_partitioned(yearly, path, "o_year")
    return read_parquet(spark, path).select("o_orderkey", "o_totalprice", "o_year")


@query
def drop_folder_load(spark, folder):
    """Files dropped before a run are loaded by it, and by no later run again."""
    orders, place = Tables(spark, folder).bronze("commandes"), scratch_folder(spark, "drop")
    raw = to_raw(orders, table("commandes"))
    for part in (F.col("CMNUMR") % 2 == 0, F.col("CMNUMR") % 2 == 1):
        write_delimited(raw.filter(part), f"{place}/in", mode="append")
        load_drop_folder(spark, f"{place}/in", table("commandes"), f"{place}/table", f"{place}/seen")
    return read_parquet(spark, f"{place}/table")


@query
def json_report_roundtrip(spark, folder):
    t = Tables(spark, folder)
    report, path = gate.amounts(t.bronze("ventes"), t.silver("ventes"), t.fact_sales), scratch_folder(spark, "report")
    write_json(report, path)
    return spark.read.schema(report.schema).json(path)


@query
def xml_products(spark, folder):
    """Products with two identifiers and two titles, written as XML and read back."""
    path = scratch_folder(spark, "products")
    both = Tables(spark, folder).given("part").select(
        mapping.isbn_of("p_partkey").alias("_isbn"), F.lpad(F.col("p_partkey").cast("string"), 10, "0").alias("_short"), "p_name", "p_type"
    )
    pair = lambda kind, value: F.struct(F.lit(kind).alias("ProductIDType"), F.col(value).alias("IDValue"))
    title = lambda kind, value: F.struct(F.lit(kind).alias("TitleType"), F.array(F.struct(F.col(value).alias("TitleText"))).alias("TitleElement"))
    products = both.select(
        F.col("_isbn").alias("RecordReference"),
        F.array(pair("15", "_isbn"), pair("02", "_short")).alias("ProductIdentifier"),
        F.struct(F.array(title("03", "p_type"), title("01", "p_name")).alias("TitleDetail")).alias("DescriptiveDetail"),
    )
    write_products(products, path)
    return product_identifiers(read_products(spark, path))


def _as_products(part: DataFrame, title: str) -> DataFrame:
    pair = F.struct(F.lit("15").alias("ProductIDType"), F.col("_isbn").alias("IDValue"))
    named = F.struct(F.lit("01").alias("TitleType"), F.array(F.struct(F.col(title).alias("TitleText"))).alias("TitleElement"))
    return part.select(
        F.col("_isbn").alias("RecordReference"), F.array(pair).alias("ProductIdentifier"), F.struct(F.array(named).alias("TitleDetail")).alias("DescriptiveDetail")
    )


@query
def onix_arrivals(spark, folder):
    """Products that arrive in two batches: the second renames some; a file that breaks off is set aside, a batch run again changes nothing."""
    place = scratch_folder(spark, "onix")
    part = Tables(spark, folder).given("part").select(mapping.isbn_of("p_partkey").alias("_isbn"), "p_partkey", "p_name", "p_type")
    arrive = lambda df, title: write_products(_as_products(df, title), f"{place}/in", "append")
    arrive(part.where("p_partkey % 4 <> 3"), "p_type")
    broken = "<ONIXMessage><Product><RecordReference>0000000000000</RecordReference></Product><Product><RecordReference>1"
    spark.createDataFrame([(broken,)], "value string").write.mode("append").text(f"{place}/in")
    load_products(spark, f"{place}/in", f"{place}/lake", f"{place}/seen")
    arrive(part.where("p_partkey % 4 >= 2"), "p_name")
    load_products(spark, f"{place}/in", f"{place}/lake", f"{place}/seen")
    merge_batch(spark.read.parquet(f"{place}/lake/data/batch/*").drop("_place"), 1, f"{place}/lake")
    set_aside = quarantined(spark, f"{place}/lake").agg(F.count("*").alias("files_set_aside"))
    found = product_identifiers(products(spark, f"{place}/lake")).select("reference", "isbn13", "titre")
    return found.join(F.broadcast(set_aside), F.lit(True))


@query
def iso_dates(spark, folder):
    text = F.when(F.col("o_orderstatus") == "P", "1998-02-30").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return Tables(spark, folder).given("orders").select("o_orderkey", iso_date(text).alias("o_day"))


@query
def incremental_pipeline_counts(spark, folder):
    """A first load, then what changed since its mark, merged by key: the table is whole."""
    source, path = _orders_priced(Tables(spark, folder)), scratch_folder(spark, "incremental")
    overwrite(source.filter(F.col("o_orderdate") < F.lit(FIRST_LOAD_END)), f"{path}/1")
    first = read_parquet(spark, f"{path}/1")
    fresh = rows_since(source, "o_orderdate", high_water_mark(first, "o_orderdate"))
    overwrite(upsert(first, fresh, ["o_orderkey"], ("o_orderdate",)), f"{path}/2")
    return read_parquet(spark, f"{path}/2").groupBy("o_orderstatus").agg(
        F.count("*").alias("nb_commandes"), measures.total("o_totalprice").alias("montant")
    )


@query
def layout_proof(spark, folder):
    """The same rows clustered and dealt out by chance: both tables are whole, and a range filter finds its rows in fewer of the clustered files."""
    place, files = scratch_folder(spark, "layout"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    sales = stored_once(Tables(spark, folder).fact_sales, "layout-sales")
    overwrite(sales.repartition(files), f"{place}/plain")
    overwrite_clustered(sales, f"{place}/clustered", ("date_vente", "isbn"), files, stored=True)
    bounds = {"date_vente": (dt.date(1998, 1, 1), dt.date(1998, 3, 31))}
    laid = {n: read_parquet(spark, f"{place}/{n}") for n in ("plain", "clustered")}
    rows = {n: df.count() for n, df in laid.items()}
    found = {n: files_holding(df, bounds).first() for n, df in laid.items()}
    fewer = found["clustered"].files < found["plain"].files and found["clustered"].row_count == found["plain"].row_count
    return spark.createDataFrame([(rows["clustered"], rows["plain"], fewer)], "row_count bigint, plain_row_count bigint, reads_fewer boolean")


@query
def sketches_within_bound(spark, folder):
    """Sketched distinct counts against exact ones, column by column; 15 % is three standard errors."""
    sales = to_raw(Tables(spark, folder).bronze("ventes"), table("ventes"))
    counted = exact_distinct(sales)
    near = F.abs(F.col("approx_distinct") - F.col("exact")) <= F.col("exact") * 0.15
    return profile_columns(sales, "VENTEP").join(counted, "column_name").select("column_name", "row_count", near.alias("within_bound"))


# Projections, filters, predicates ----------------------------------------------------------------


@query
def trim_fixed_width(spark, folder):
    padded = pad_fixed(Tables(spark, folder).bronze("auteurs"), table("auteurs"))
    return padded.select(
        trim_fixed("AUCODE").alias("code_auteur"),
        trim_fixed("AUNOM").alias("nom"),
        trim_fixed("AUPSEUD").alias("pseudonyme"),
        F.length("AUNOM").alias("largeur_nom"),
    )


@query
def cyymmdd_to_date_lines(spark, folder):
    lines = Tables(spark, folder).given("lineitem")
    good = date_to_cyymmdd("date(l_shipdate)")
    line = F.col("l_linenumber")
    code = F.when(line == 7, good + 1200).when(line == 6, 0).otherwise(good)
    return (
        lines.select(code.alias("code"))
        .select("code", cyymmdd_to_date("code").alias("decoded"))
        .groupBy("code", "decoded")
        .agg(F.count("*").alias("row_count"))
    )


@query
def date_to_cyymmdd_orders(spark, folder):
    return Tables(spark, folder).given("orders").select(
        "o_orderkey", date_to_cyymmdd("date(o_orderdate)").alias("code")
    )


@query
def typed_amounts(spark, folder):
    orders = Tables(spark, folder).given("orders")
    amount = F.col("o_totalprice").cast("decimal(11,2)").cast("string")
    texts = orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.concat(amount, F.lit(" EUR"))).otherwise(amount).alias("amount"),
        F.substring("o_orderpriority", 1, 3).alias("priority"),
        F.substring("o_orderpriority", 1, 1).alias("rank"),
    )
    return texts.select(
        "o_orderkey",
        typed("amount", "decimal(11,2)").alias("montant"),
        typed("rank", "int").alias("rang"),
        typed("priority", "int").isNull().alias("illisible"),
    )


PART_COLUMNS = [
    {"name": "P_PARTKEY", "type": "BIGINT", "is_pk": True},
    {"name": "P_NAME", "type": "CHAR", "length": 40, "ccsid": 297},
    {"name": "P_SIZE", "type": "SMALLINT"},
    {"name": "P_RETAILPRICE", "type": "DECIMAL", "length": 9, "scale": 2},
    {"name": "P_TYPE", "type": "XYZ"},
]


@query
def metadata_cast(spark, folder):
    part = Tables(spark, folder).given("part")
    texts = part.select([F.col(m["name"]).cast("string").alias(m["name"]) for m in PART_COLUMNS])
    keyless = [{**m, "is_pk": False} for m in PART_COLUMNS]
    return clean_by_metadata(texts, keyless)


@query
def metadata_clean(spark, folder):
    sales = to_raw(Tables(spark, folder).bronze("ventes"), table("ventes"))
    return clean_by_metadata(sales, table("ventes").metadata(), ("vedtvt",))


@query
def strip_control_chars(spark, folder):
    documents = Tables(spark, folder).given("documents")
    stripped = documents.select("doc_id", strip_controls("text").alias("_text"), F.length("text").alias("_before"))
    return stripped.select(
        "doc_id",
        F.length("_text").alias("nb_caracteres"),
        (F.col("_before") - F.length("_text")).alias("nb_retires"),
        F.md5(F.col("_text").cast("binary")).alias("empreinte"),
    )


@query
def movement_type(spark, folder):
    sales = Tables(spark, folder).bronze("ventes")
    return sales.groupBy("VESTAT").agg(F.count("*").alias("row_count")).select(
        "VESTAT", movement_label("VESTAT").alias("type_mouvement"), "row_count"
    )


@query
def format_status_label(spark, folder):
    books = Tables(spark, folder).bronze("ouvrages")
    return books.select(
        F.col("OVISBN").alias("isbn"),
        format_label("OVFMT").alias("libelle_format"),
        status_label("OVSTAT").alias("libelle_statut"),
    )


@query
def price_band_books(spark, folder):
    books = Tables(spark, folder).silver("ouvrages")
    known = F.when(F.col("statut") != "AN", F.col("prix_ttc"))
    return books.select("isbn", "prix_ttc", price_band(known).alias("tranche_prix"))


@query
def isbn13_valid_sales(spark, folder):
    sales = Tables(spark, folder).bronze("ventes").select(F.col("VEISBN").alias("isbn"))
    checked = sales.select("isbn", isbn13_valid("isbn").alias("isbn_valide"))
    return checked.groupBy("isbn", "isbn_valide").agg(F.count("*").alias("row_count"))


@query
def isbn13_shape(spark, folder):
    part = Tables(spark, folder).given("part")
    isbn = mapping.isbn_of("p_partkey")
    size = F.col("p_size")
    written = (
        F.when(size == 1, F.lit(None))
        .when(size == 2, F.concat(F.lit(" "), isbn))
        .when(size == 3, F.substring(isbn, 1, 12))
        .when(size == 4, F.concat(F.lit("977"), F.substring(isbn, 4, 10)))
        .otherwise(isbn)
    )
    return part.select("p_partkey", written.alias("_isbn")).select(
        "p_partkey",
        isbn13_has_shape("_isbn").alias("bonne_forme"),
        isbn13_valid("_isbn").alias("isbn_valide"),
    )


@query
def isbn10_to_13_books(spark, folder):
    part = Tables(spark, folder).given("part")
    short = mapping.isbn10_of("p_partkey")
    return part.select("p_partkey", short.alias("isbn10")).select(
        "p_partkey",
        "isbn10",
        isbn10_to_13("isbn10").alias("isbn13"),
        normalise_isbn("concat_ws('-', substring(isbn10, 1, 4), substring(isbn10, 5, 6))").alias("normalise"),
    )


@query
def stock_total(spark, folder):
    stock = Tables(spark, folder).silver("stocks")
    return stock.select(
        "isbn", "code_entrepot", "date_position", "qte_disponible", "qte_pilonnee", "qte_totale"
    )


@query
def display_name(spark, folder):
    return Tables(spark, folder).dim_author.select("code_auteur", "nom_complet")


@query
def null_flag(spark, folder):
    authors = Tables(spark, folder).silver("auteurs")
    return authors.select("code_auteur", is_missing("date_deces").alias("est_vivant"))


@query
def accent_search(spark, folder):
    documents = Tables(spark, folder).given("documents")
    return documents.filter(contains_any(["text"], SEARCHED_IN_NAMES)).select("doc_id", "lang")


@query
def accent_audit(spark, folder):
    return gate.accent_audit("documents", Tables(spark, folder).given("documents"), ["text"])


# Calendar ----------------------------------------------------------------------------------------


@query
def dim_date(spark, folder):
    return calendar_covering(Tables(spark, folder).silver("ventes"), "date_vente")


# Joins -------------------------------------------------------------------------------------------


@query
def fact_stock(spark, folder):
    return Tables(spark, folder).gold("stocks")


@query
def fk_orphans_sales(spark, folder):
    t = Tables(spark, folder)
    return orphan_keys(t.silver("ventes"), t.dim_book, "isbn")


@query
def fk_orphans_books(spark, folder):
    t = Tables(spark, folder)
    return orphan_keys(t.silver("ouvrages"), t.dim_publisher, "code_editeur")


@query
def calendar_orphans(spark, folder):
    t = Tables(spark, folder)
    settled = t.silver("ventes").select(F.col("date_reglement").alias("date_id"))
    days = calendar_covering(t.silver("ventes").filter("type_mouvement = 'Retour'"), "date_vente")
    return orphan_keys(settled, days, "date_id")


@query
def latest_position(spark, folder):
    stock = to_raw(Tables(spark, folder).bronze("stocks"), table("stocks"))
    return latest_with_ties(stock, ["SKISBN", "SKENTR"], "SKDTPS").select(table("stocks").source_columns)


@query
def book_authors(spark, folder):
    t = Tables(spark, folder)
    return gold.book_authors(t.bridge, t.dim_author)


@query
def lead_authors(spark, folder):
    t = Tables(spark, folder)
    return gold.named_leads(t.bridge, t.dim_author)


@query
def resolve_codes(spark, folder):
    t = Tables(spark, folder)
    per_code = t.silver("ventes").groupBy("canal", "code_entrepot").agg(
        F.count("*").alias("nb_mouvements"), measures.total("montant_ttc").alias("montant_ttc")
    )
    lookups = {n: t.silver(n) for n in ("ref_canaux", "ref_entrepots")}
    return gold.resolve_codes(per_code, lookups, ["canal", "code_entrepot"])


@query
def sales_by_publisher_author_month(spark, folder):
    t = Tables(spark, folder)
    leads = gold.named_leads(t.bridge, t.dim_author)
    return measures.sales_by_publisher_author_month(t.fact_sales, t.dim_book, t.dim_publisher, leads)


# Aggregations and measures -----------------------------------------------------------------------


@query
def amount_balance(spark, folder):
    t = Tables(spark, folder)
    return recon.amount_balance(t.bronze("ventes"), t.silver("ventes"), t.fact_sales)


@query
def control_totals(spark, folder):
    sales = Tables(spark, folder).bronze("ventes")
    return recon.control_totals(sales, "VENTEP", "VEMTHT", "VEMTTTC", "VEQTE", "VEDTVT")


@query
def table_counts(spark, folder):
    t = Tables(spark, folder)
    return recon.table_counts({table(n).source: t.bronze(n) for n in COUNTED})


@query
def load_verification(spark, folder):
    return recon.load_verification(Tables(spark, folder).fact_sales)


@query
def isbn_invalid_rate(spark, folder):
    return recon.invalid_rate(Tables(spark, folder).silver("ouvrages"))


@query
def net_sales(spark, folder):
    return measures.net_sales(Tables(spark, folder).fact_sales)


@query
def sales_by_book_day_channel(spark, folder):
    return measures.sales_by_book_day_channel(Tables(spark, folder).fact_sales)


@query
def sales_by_month(spark, folder):
    return measures.sales_by_month(Tables(spark, folder).fact_sales)


@query
def top_authors(spark, folder):
    t = Tables(spark, folder)
    return measures.top_authors(t.fact_sales, t.bridge, t.dim_author)


@query
def share_by_format(spark, folder):
    t = Tables(spark, folder)
    return measures.share_by_format(t.fact_sales, t.dim_book)


@query
def sales_filtered(spark, folder):
    t = Tables(spark, folder)
    return measures.sales_filtered(t.fact_sales, t.dim_book, REPORT_PUBLISHER, REPORT_YEAR)


@query
def author_total_window(spark, folder):
    t = Tables(spark, folder)
    return measures.author_totals(t.fact_sales, t.bridge)


@query
def royalties(spark, folder):
    t = Tables(spark, folder)
    return measures.royalties(t.fact_sales, t.silver("contrats"), t.bridge)


@query
def royalty_ledger(spark, folder):
    t = Tables(spark, folder)
    return measures.royalty_ledger(t.fact_sales, t.silver("contrats"), t.bridge)


@query
def order_fill(spark, folder):
    return measures.order_fill(gold.fact_orders(Tables(spark, folder).silver("commandes")))


@query
def stock_by_site(spark, folder):
    return measures.stock_by_site(Tables(spark, folder).gold("stocks"))


# Dedupe and keys ---------------------------------------------------------------------------------


@query
def dedupe_latest(spark, folder):
    return keep_latest(Tables(spark, folder).silver("ventes"), ["num_mouvement"], ("date_vente",))


@query
def dedupe_loss(spark, folder):
    return collapse_report(
        Tables(spark, folder).silver("ventes"),
        num_mouvement=["num_mouvement"],
        isbn_date_canal=["isbn", "date_vente", "canal"],
    )


@query
def surrogate_keys(spark, folder):
    """Rows, keys and collisions of the book and author dimensions."""
    t = Tables(spark, folder)

    def checked(name, df, key, natural):
        collisions = key_collisions(df, key, [natural]).select(F.lit(1).cast("bigint").alias("_bad"))
        counted = df.agg(F.count("*").alias("row_count"), F.count_distinct(F.col(key)).alias("key_count"))
        return union_evolved(counted, collisions).agg(
            F.lit(name).alias("table_name"),
            F.max("row_count").alias("row_count"),
            F.max("key_count").alias("key_count"),
            F.coalesce(F.sum("_bad"), F.lit(0)).cast("bigint").alias("collisions"),
        )

    return checked("dim_ouvrages", t.dim_book, "ouvrage_key", "isbn").unionByName(
        checked("dim_auteurs", t.dim_author, "auteur_key", "code_auteur")
    )


# Gold --------------------------------------------------------------------------------------------


@query
def dim_publisher(spark, folder):
    return Tables(spark, folder).dim_publisher.drop("editeur_key")


@query
def dim_author(spark, folder):
    return Tables(spark, folder).dim_author.drop("auteur_key")


@query
def author_contracts(spark, folder):
    t = Tables(spark, folder)
    return gold.author_contracts(t.dim_author, t.silver("contrats"), FIRST_LOAD_END).select(
        "code_auteur", "nom_complet", "nb_contrats", "nb_contrats_en_cours", "pct_droits_min", "pct_droits_max", "total_avances", "premier_contrat"
    )


@query
def orders_with_publisher(spark, folder):
    t = Tables(spark, folder)
    return gold.orders_with_publisher(gold.fact_orders(t.silver("commandes")), t.dim_book).select(
        "num_commande", "date_commande", "code_editeur", "qte_commandee", "montant_ht"
    )


@query
def dim_book(spark, folder):
    return Tables(spark, folder).dim_book.drop("ouvrage_key")


@query
def fact_sales(spark, folder):
    return Tables(spark, folder).fact_sales


@query
def excluded_sales(spark, folder):
    return excluded_rows(Tables(spark, folder).silver("ventes")).select(
        "num_mouvement", "isbn", "date_vente", "quantite", "montant_ttc"
    )


@query
def dim_collection(spark, folder):
    t = Tables(spark, folder)
    return gold.dim_collection(t.silver("collections"), t.silver("editeurs")).drop("collection_key")


@query
def dim_site(spark, folder):
    return gold.dim_warehouse(Tables(spark, folder).silver("ref_entrepots")).drop("entrepot_key")


@query
def fact_orders(spark, folder):
    return gold.fact_orders(Tables(spark, folder).silver("commandes"))


# Layout and monitoring ---------------------------------------------------------------------------


@query
def cluster_same_rows(spark, folder):
    return cluster_by(Tables(spark, folder).fact_sales, ("date_vente", "isbn"))


@query
def layout_report(spark, folder):
    """In how many files a range filter finds rows, and how many."""
    found = files_holding(Tables(spark, folder).given("lineitem"), FILE_FILTER)
    return found.select((F.col("files") > 0).alias("in_files"), "row_count")


@query
def freshness(spark, folder):
    return monitor.freshness(mapping.load_log(spark, folder), WATCHED, AS_OF)


@query
def volume_anomaly(spark, folder):
    return monitor.volume_anomalies(mapping.load_log(spark, folder), deviations=2)


@query
def cosine_topk_per_label(spark, folder):
    """The nearest vectors to the first vector of each label."""
    vectors = Tables(spark, folder).given("embeddings")
    first = vectors.groupBy("label").agg(F.min("vec_id").alias("vec_id")).select("vec_id")
    chosen = vectors.join(first, "vec_id", "left_semi").select(F.col("vec_id").alias("query_id"), "embedding")
    return cosine_topk(vectors, chosen, k=5)


@query
def cosine_blocks_skipped(spark, folder):
    """The nearest vectors to every twentieth: all pairs of a query and a block are searched or skipped."""
    vectors = Tables(spark, folder).given("embeddings")
    asked = vectors.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    told = CosineSearch(vectors, asked, k=5).skipped()
    return told.select("queries", (F.col("searched") + F.col("skipped") == F.col("queries") * F.col("blocks")).alias("accounted_for"))


# Quality gate ------------------------------------------------------------------------------------

ENTITIES = ("ouvrages", "ventes", "stocks", "editeurs", "auteurs")


def _layers(t: Tables) -> list[gate.Layers]:
    return [gate.Layers(n, t.bronze(n), t.silver(n), t.gold(n), n == "ventes") for n in ENTITIES]


@query
def gate_completeness(spark, folder):
    return gate.completeness(_layers(Tables(spark, folder)))


@query
def gate_row_loss(spark, folder):
    t = Tables(spark, folder)
    deduped = keep_latest(t.silver("ventes"), ["num_mouvement"], ("date_vente",))
    return gate.row_loss("ventes", t.bronze("ventes"), deduped)


@query
def gate_null_ratio(spark, folder):
    t = Tables(spark, folder)
    return gate.null_ratio("auteurs", t.silver("auteurs")).unionByName(
        gate.null_ratio("ventes", t.silver("ventes"))
    )


@query
def gate_unreadable(spark, folder):
    return gate.unreadable("ouvrages", Tables(spark, folder).bronze("ouvrages"), table("ouvrages"))


@query
def gate_isbn(spark, folder):
    t = Tables(spark, folder)
    return gate.isbn_checksum("ouvrages", t.silver("ouvrages")).unionByName(
        gate.isbn_checksum("ventes", t.silver("ventes"), gate.STRICT_LIMITS)
    )


@query
def gate_isbn_shape(spark, folder):
    return gate.isbn_shape("ventes", Tables(spark, folder).silver("ventes"))


@query
def gate_dates(spark, folder):
    t = Tables(spark, folder)
    return gate.dates("ouvrages", t.silver("ouvrages"), "date_publication").unionByName(
        gate.dates("ventes", t.silver("ventes"), "date_reglement")
    )


EXPECTED_BOOKS = [
    gate.Expected("format of the sale items", "titre LIKE 'red widget%'", "format IN ('GFT','POC','NUM','AUD','BDA','ECO')"),
    gate.Expected("all brands named", "commentaire LIKE 'Brand#%'", "code_editeur LIKE 'S00000000_'"),
    gate.Expected("known title", "titre = 'no such title'", "isbn_valide"),
]


@query
def gate_expected(spark, folder):
    return gate.expected_values(Tables(spark, folder).silver("ouvrages"), EXPECTED_BOOKS)


@query
def gate_amounts(spark, folder):
    t = Tables(spark, folder)
    return gate.amounts(t.bronze("ventes"), t.silver("ventes"), t.fact_sales)


@query
def gate_accents(spark, folder):
    return gate.accents([gate.accent_audit("documents", Tables(spark, folder).given("documents"), ["text"])])


@query
def gate_integrity(spark, folder):
    t = Tables(spark, folder)
    return gate.integrity("fk ventes to ouvrages", t.silver("ventes"), t.dim_book, "isbn").unionByName(
        gate.integrity("fk ventes to ref_canaux", t.silver("ventes"),
                       t.silver("ref_canaux").withColumnRenamed("code", "canal"), "canal")
    )


@query
def gate_summary(spark, folder):
    t = Tables(spark, folder)
    checks = gate.full_gate(
        {n: t.bronze(n) for n in ENTITIES},
        {n: t.silver(n) for n in ENTITIES},
        {g: t.gold(n) for n, g in gate.GOLD_NAMES.items()},
    )
    return gate.summary(checks)

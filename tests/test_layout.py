from pyspark.sql import functions as F

from quire.operators import clustering
from quire.session import stored_once
from quire.trial.catalogue import QUERIES, Tables


def test_layout_proof_is_about_all_rows(spark, small_folder):
    row = QUERIES["layout_proof"](spark, small_folder).first()
    rows = Tables(spark, small_folder).fact_sales.count()
    assert (row.row_count, row.plain_row_count, row.reads_fewer) == (rows, rows, True)


def test_clustering_is_cut_as_the_session_says(spark, small_folder):
    """Not into a fixed number of parts, which would grow with the table."""
    parts = QUERIES["cluster_same_rows"](spark, small_folder).select(F.spark_partition_id()).distinct().count()
    assert parts == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_a_stored_table_is_not_written_again(spark, small_folder, monkeypatch):
    stored = stored_once(Tables(spark, small_folder).fact_sales, "layout-test")
    monkeypatch.setattr(clustering, "stored_once", None)
    assert clustering.cluster_by(stored, ("date_vente",), 3, stored=True).count() == stored.count()

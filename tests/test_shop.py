"""The shop's pages as the workload makes and the library parses them."""

from pyspark.sql import functions as F

from shopgrain.sources import pages as P
from workload import queries, tables as W


def parts(spark, n):
    """All in one task, as a small file is read."""
    return spark.range(0, n, 1, 1).selectExpr(
        "id AS p_partkey", "concat('part ', id) AS p_name", "'B' AS p_brand", "'T' AS p_type",
        "int(id % 50) AS p_size", "double(id) AS p_retailprice",
    )


def test_pages_of_a_table_that_is_one_task_are_parsed_by_many(spark):
    texts = P.product_texts(W.shop_details(parts(spark, 800)))
    rows = texts.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert sum(r["count"] for r in rows) == 800
    assert len(rows) > 1 and max(r["count"] for r in rows) <= 400


def test_a_step_over_tags_works_nothing_out_twice(spark):
    crumb = str(P._link_in_child(F.col("block"), "li", 3))
    assert crumb.count("split(") == 1 and crumb.count("reverse(") == 1
    main = str(P._main_block(F.col("html"), "div", "product_main"))
    assert main.count("split(") == 1 and main.count("array_position(") == 1


ROWS = [(1, b"<p>a"), (2, b"\xe9\r\n"), (2, b""), (3, None), (None, b"n"), (-4, b"\x00\xff")]


def files_below(folder):
    """Per page folder the content of its files, put together."""
    found = {}
    for f in sorted(folder.glob("page_id=*/[!.]*")):
        found[f.parent.name] = found.get(f.parent.name, b"") + f.read_bytes()
    return found


def test_page_files_are_those_of_the_text_writer_and_nothing_else(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, "page_id bigint, value binary").coalesce(1)
    pages = pages.withColumn("value", F.col("value").cast("string"))
    pages.write.partitionBy("page_id").text(str(tmp_path / "spark"))
    W.write_page_files(pages, str(tmp_path / "tasks"))
    # The same rows in a store that is no local folder.
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.shop.link./far", f"file://{tmp_path}")
    W.write_page_files(pages, "viewfs://shop/far/viewed")
    expected = files_below(tmp_path / "spark")
    assert expected["page_id=1"] == b"<p>a\n" and len(expected) == 5
    assert files_below(tmp_path / "tasks") == files_below(tmp_path / "viewed") == expected
    # No checksum beside a page: that is one more file, and one more process to write it.
    assert not list((tmp_path / "tasks").glob("page_id=*/.*"))


def test_a_table_without_pages_leaves_an_empty_folder(spark, tmp_path):
    none = spark.createDataFrame([], "page_id bigint, value string")
    W.write_page_files(none, str(tmp_path / "none"))
    assert P.pages_from_files(spark, str(tmp_path / "none")).count() == 0


def test_stored_pages_start_no_process_for_a_page(spark, tmp_path, monkeypatch):
    """Spark's own writer, in a local folder, leaves a checksum beside every page."""
    spark.range(30).selectExpr("id AS page_id", "'u' AS url", "concat('<h1>', id, '</h1>') AS html").write.parquet(
        str(tmp_path / "pages.parquet")
    )
    source = tmp_path / "source"
    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: str(source))
    rows = {r.page_id: r.h1 for r in queries.stored_pages(spark, str(tmp_path)).collect()}
    assert rows == {i: str(i) for i in range(30)}
    assert len(list(source.rglob("part-*"))) == 30 and not list(source.rglob(".part-*"))

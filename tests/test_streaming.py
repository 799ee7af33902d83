from eventweave.sources import fixtures
from eventweave.streaming import incremental


def test_new_files_build_and_replace_their_months(spark, tmp_path):
    pages = fixtures.portal_pages(spark)
    source, graph, mark = (f"file://{tmp_path}/{n}" for n in ("pages", "graph", "mark"))
    pages.write.parquet(source)
    incremental.watch(spark, source, graph, mark).awaitTermination(120)
    first = spark.read.parquet(graph).count()
    assert first == incremental.build(pages).dropDuplicates(["module", "month", "s", "p", "o"]).count()
    pages.withColumn("month", pages.month).write.mode("append").parquet(source)
    incremental.watch(spark, source, graph, mark).awaitTermination(120)
    assert spark.read.parquet(graph).count() == first

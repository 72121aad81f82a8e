"""S-8: the short page ends a list; N-3: nested tickets equal the flat ones."""

from pyspark.sql import functions as F

from boxoffice.operators import facts as fc
from boxoffice.operators import ingest as ig

PAGE = "event_id string, page_no long, error string, rows array<string>"


def _pages(spark, lists):
    """{event: {page: rows or error}}"""
    return spark.createDataFrame([(e, n, r if isinstance(r, str) else None, [] if isinstance(r, str) else r)
                                  for e, pages in lists.items() for n, r in pages.items()], PAGE)


LISTS = {"a": {1: ["1", "2"], 2: ["3"], 5: ["1", "2"]},         # a stray page after the end
         "b": {1: ["1", "2"], 2: []},                          # the last page was full
         "c": {1: ["1", "2"], 4: ["7"]},                       # two pages missing
         "d": {1: ["1", "2"], 2: ["3", "4"]},                  # no end yet
         "e": {1: "no_data"}, "f": {1: []}, "g": {3: ["1", "2"], 2: ["3"]}}


def _hot(spark, *events):
    return spark.createDataFrame([(e, 3) for e in events], "hot_key string, hot_buckets int")


def test_listed_pages_and_audit(spark):
    pages = _pages(spark, LISTS)
    for hot in (_hot(spark), _hot(spark, "a", "c")):
        got = ig.listed_pages(pages, 2, hot)
        assert sorted((r.event_id, r.page_no) for r in got.collect()) == [
            ("a", 1), ("a", 2), ("b", 1), ("b", 2), ("c", 1), ("c", 4), ("d", 1), ("d", 2), ("f", 1), ("g", 2)]
        audit = {r.event_id: tuple(r)[1:] for r in ig.page_audit(pages, 2, hot).collect()}
        # end page, rows, pages, missing before the end, after the end
        assert audit == {"a": (2, 3, 2, 0, 1), "b": (2, 2, 2, 0, 0), "c": (4, 3, 2, 2, 0), "d": (None, 4, 2, 0, 0),
                         "f": (1, 0, 1, 0, 0), "g": (2, 1, 1, 1, 1)}
    assert ig.page_audit(_pages(spark, {}), 2, _hot(spark)).count() == 0


def test_page_files_are_full_but_for_the_last(tables):
    """The landed order pages: full pages, then a short one; every order on one page."""
    p = tables.order_pages.filter(F.col("error").isNull()).join(
        ig.order_page_audit(tables), "event_id").filter(F.col("page_no") <= F.col("end_page"))
    assert p.filter((F.size("rows") < 100) != (F.col("page_no") == F.col("end_page"))).count() == 0
    assert p.agg(F.sum(F.size("rows"))).first()[0] == tables.orders.count()
    assert tables.order_pages.filter(F.col("error") == "no_data").count() == ig.events_without_orders(tables).count()


def test_nested_equals_flat(tables):
    a, b = ig.tickets_unnested(tables), ig.tickets_flat(tables)
    assert sorted(a.columns) == sorted(b.columns)
    a = a.select(*b.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert fc.bi_ticket_unnested(tables).count() == fc.bi_ticket_dataset(tables).count()
    types = {f.name for f in ig.nested_orders(tables).schema["ticket"].dataType.elementType.fields}
    assert types == set(b.columns)


def test_pages_carry_the_tickets_once(tables):
    """Every page is gathered once: the ends of the lists and the stray pages come from the numbers of rows."""
    from boxoffice.sources import raw

    plan = raw.order_pages(tables)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list(struct(id") == 2  # an order's tickets, a page's orders
    stray = tables.order_pages.filter(F.col("event_id").cast("long") % 17 == 3).filter(F.col("error").isNull()).groupBy("event_id").agg(
        F.max("page_no").alias("last"), F.min(F.struct("page_no", F.size("rows").alias("n"))).alias("first"),
        F.max(F.struct("page_no", F.size("rows").alias("n"))).alias("stray")).collect()
    assert stray and all(r.stray.n == r.first.n and r.stray.page_no > 3 for r in stray)


def test_page_files_are_small_on_disk(tables):
    assert all(f.endswith(".json.gz") for f in tables.order_pages.inputFiles())

"""SQL functions give what the column expressions give."""

from pyspark.sql import functions as F

from winnowkit.functions import careers, hosts, keys, registered, text
from winnowkit.sources import pages


def test_functions_in_sql_are_the_expressions(spark):
    registered.register(spark)
    rows = [
        ("https://me@www.Foo.com:80/a/b?x=1&cid=7", "adp"), ("http://jobs.lever.co/Foo/9-a'b\\c", "lever"), ("https://x.taleo.net/careersection/requisition.jsp?org=A%20B&cws=39&z=1", "taleo_rss"),
        ("https://e.oraclecloud.com/hcm/sites/CX_1/job/2", "oraclecloud"), (None, None), ("", ""), ("no host", "Workday"), ("a" * 50_000 + ".com", "host"), ("https://[::1]/x", "é"),
    ]
    d = spark.createDataFrame(rows, "u string, s string")
    d.createOrReplaceTempView("links")
    link = careers.careers_link(F.col("u"), F.col("s"))
    want = d.select(
        hosts.normalize_host(F.col("u")), link["url"], link["tier"], careers.entry_url(link["url"], F.col("u")), hosts.covers(F.col("s"), F.col("u")), text.level_signature(F.col("s")),
        keys.match_keys(F.col("u"), F.array("s"), F.col("s")), pages.embedded(F.col("u"), "//", "/"), careers.search_link(F.col("s")), text.tokens(F.col("u")),
    )
    got = spark.sql(
        "SELECT wk_host_of(u), wk_careers_link(u, s).url, wk_careers_link(u, s).tier, wk_careers_entry(wk_careers_link(u, s).url, u), wk_host_covers(s, u), wk_title_level(s), "
        "wk_posting_keys(u, array(s), s), wk_text_between(u, '//', '/'), wk_careers_search(s), wk_title_tokens(u) FROM links"
    )
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()


def test_rows_of_pages_in_sql(spark):
    texts = ['{"pageProps":{"ssrHits":[{"id":1},5,{"id":2}],"nbHits":3}}', '{"none":[],"zeta":[{"id":"z"}],"alpha":[{"objectID":"a"}]}', '{"pageProps":{"ssrHits":[]}}', '{"pageProps":{"x":1}}']
    d = spark.createDataFrame(list(enumerate(texts)), "page int, payload string")
    d.createOrReplaceTempView("result_pages_of_test")
    registered.register(spark)
    want = pages.records(d).select("page", "pos", F.col("record").cast("string"))
    got = spark.sql("SELECT page, pos, CAST(record AS STRING) FROM result_pages_of_test, LATERAL wk_page_rows(payload) WHERE startswith(schema_of_variant(record), 'OBJECT')")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() == 3
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan  # a generator over the pages, as the DataFrame has it
    assert spark.sql("SELECT wk_page_totals_of(payload) FROM result_pages_of_test WHERE page = 0").first()[0] == {"nbHits": 3.0}


def test_operators_inside_texts_stay(spark):
    d = spark.createDataFrame([("=(",), ("a",), (None,)], "x string")
    d.createOrReplaceTempView("texts_of_test")
    e = F.when((F.col("x") == "=(") | F.col("x").isin("and(", "it's\\("), "or(x)").otherwise(F.concat("x", F.lit("!(")))
    assert [r[0] for r in spark.sql(f"SELECT {registered.body(e)} FROM texts_of_test").collect()] == [r[0] for r in d.select(e).collect()]

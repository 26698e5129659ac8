"""The fact over the sales' own catalogue: keys computed on the lines, without a join on the product pair."""

from tillwork.operators import star


def test_own_catalogue_keys_need_no_product_join(spark):
    sales = spark.createDataFrame(
        [
            ("1", "a ", "cup", 2, 1.5, "C1", "EIRE", "2011-01-01", "10:00", "SALE"),
            ("1", "a ", "cup", 2, 1.5, "C1", "EIRE", "2011-01-01", "10:00", "SALE"),
            ("2", "b", None, -1, 2.0, "C2", None, "2011-01-02", "11:00", "RETURN"),
            ("3", None, "plate", 1, 3.0, None, "Spain", None, None, "SALE"),
        ],
        "INVOICE STRING, STOCKCODE STRING, DESCRIPTION STRING, QUANTITY BIGINT, PRICE DOUBLE, CUSTOMER_ID STRING, "
        "COUNTRY STRING, INVOICE_DATE STRING, INVOICE_TIME STRING, INVOICE_TYPE STRING",
    )
    countries = spark.createDataFrame([("EIRE",), ("Spain",)], "COUNTRY_RAW STRING")
    products = sales.selectExpr("STOCKCODE", "DESCRIPTION AS DESCRIPTION_RAW").distinct()
    joined = star.fact_sales(sales, countries, products)
    own = star.fact_sales(sales, countries, None)
    assert sorted(own.collect(), key=str) == sorted(joined.collect(), key=str)
    assert own.filter("PRODUCT_ID IS NULL").count() == 2
    plan = own._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1


def test_fact_of_joins_no_product_pairs(spark):
    from tillwork.plans import views

    sales = spark.createDataFrame([("1", "a", "cup", "EIRE")], "INVOICE STRING, STOCKCODE STRING, DESCRIPTION STRING, COUNTRY STRING")
    sales = sales.selectExpr("*", "1L AS QUANTITY", "1.0D AS PRICE", "'C1' AS CUSTOMER_ID", "'2011-01-01' AS INVOICE_DATE",
                             "'10:00' AS INVOICE_TIME", "'SALE' AS INVOICE_TYPE")
    plan = views.fact_of(spark, "/root/testdata/sf0.001", sales)._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Join" in line and "STOCKCODE" in line]

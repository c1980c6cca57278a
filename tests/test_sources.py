import json
import os

from pyspark.sql import functions as F

from revlens.sources import readers, schemas, sinks


def test_csv_roundtrip_multiline_quotes(spark, tmp_dir):
    rows = [(1, 2, 3, "An", "5", "t", 'line1\nline2, "quoted"', "1700000000", "1690000000", 9, "S")]
    df = spark.createDataFrame(rows, schemas.COMMENT_SCHEMA)
    path = os.path.join(tmp_dir, "c")
    sinks.write_csv(df, path, single_file=True)
    back = readers.read_part_dir(spark, path, schemas.COMMENT_SCHEMA)
    assert back.collect() == df.collect()


def test_malformed_rows_dropped(spark, tmp_dir):
    p = os.path.join(tmp_dir, "m")
    os.makedirs(p)
    with open(os.path.join(p, "part-0000.csv"), "w") as f:
        f.write("a,b\n1,2\nx,3\n4,5\n")
    df = readers.read_part_dir(spark, p, "a int, b int")
    assert sorted(tuple(r) for r in df.collect()) == [(1, 2), (4, 5)]


def test_flatten_review_product_listing_json(spark, tmp_dir):
    reviews = [{"id": 1, "product_id": 5, "customer_id": 7, "rating": 5, "title": "t", "content": "c",
                "created_at": 1700000000, "created_by": {"id": 7, "name": "An", "purchased_at": 1690000000},
                "seller": {"id": 3, "name": "S"}},
               {"id": 2, "product_id": 5, "customer_id": 8, "rating": 4, "content": "d", "created_at": 1700000001,
                "created_by": None, "seller": None}]
    p = os.path.join(tmp_dir, "r.json")
    with open(p, "w") as f:
        f.write("\n".join(json.dumps(r) for r in reviews))
    flat = {r.comment_id: r for r in readers.flatten_reviews(p, spark).collect()}
    assert flat[1].customer_name == "An" and flat[1].purchased_at == 1690000000 and flat[1].seller_name == "S"
    assert flat[2].customer_name is None and flat[2].seller_id is None
    prod = spark.createDataFrame([(json.dumps({"id": 9, "name": "P", "brand": {"name": "B"}}),)], "j string")
    assert readers.flatten_products(prod).first().brand_name == "B"
    listing = spark.createDataFrame([(json.dumps({"data": [{"id": 1}, {"id": 0}, {"id": 1}, {"id": None}, {"id": 2}]}),)], "j string")
    assert sorted(r.product_id for r in readers.flatten_product_ids(listing).collect()) == [1, 2]


def test_rule_model_persist_and_exports(spark, tmp_dir):
    from revlens.operators import patterns
    t = spark.createDataFrame([(i, x) for i, x in enumerate([[1, 2], [1, 2], [2, 3], [1, 2, 3]])],
                              "customer_id long, items array<long>")
    model, itemsets, rules = patterns.train_fp_growth(t, 0.5, 0.5, 1.0)
    sinks.save_rule_model(model, itemsets, rules, os.path.join(tmp_dir, "m"), {"min_support": 0.5})
    _, its2, rules2, params = sinks.load_rule_model(spark, os.path.join(tmp_dir, "m"))
    assert its2.count() == itemsets.count() and rules2.count() == rules.count() and params == {"min_support": 0.5}
    ex = sinks.export_rules(rules).collect()
    assert all(len(r.Lift.split(".")[1]) == 4 for r in ex)
    names = spark.createDataFrame([(1, "one")], "product_id long, product_name string")
    named = sinks.export_rules_named(rules, names).collect()
    assert any("Unknown_ID_2" in (r.Antecedent_Product_Name + r.Consequent_Product_Name) for r in named)
    recs = spark.createDataFrame([(5, 1, 1), (5, 2, 77)], "customer_id long, rank int, product_id long")
    out = {r.Product_ID: r.Product_Name for r in sinks.export_recommendations(recs, names).collect()}
    assert out == {1: "one", 77: "Unknown"}


def test_named_outputs_and_partitioned_parquet(spark, tmp_dir):
    df = spark.createDataFrame([(1, "2024-01"), (2, "2024-02")], "id int, month string")
    sinks.write_named_outputs({"fact": df, "summary": df.groupBy().count()}, tmp_dir, partition_by={"fact": ["month"]})
    back = spark.read.parquet(os.path.join(tmp_dir, "fact")).filter(F.col("month") == "2024-02")
    assert [r.id for r in back.collect()] == [2]


def test_fact_by_month_is_rewritten_month_by_month_and_pruned(spark, tmp_dir):
    import datetime as dt
    rows = [(i, f"c{i}", dt.datetime(2024, 1 + i % 3, 1 + i % 28)) for i in range(90)] + [(900, "none", None)]
    fact = spark.createDataFrame(rows, "comment_id long, content string, purchased_at_ts timestamp")
    path = f"{tmp_dir}/fact"
    sinks.write_fact(fact, path)
    back = sinks.read_fact(spark, path)
    assert back.count() == 91 and back.filter("month = '2024-02'").count() == 30
    new = spark.createDataFrame([(1, "new", dt.datetime(2024, 2, 3))], fact.schema)
    sinks.write_fact(new, path)
    got = {(r.month, r.n) for r in sinks.read_fact(spark, path).groupBy("month").agg(F.count("*").alias("n")).collect()}
    assert got == {("2024-01", 30), ("2024-02", 1), ("2024-03", 30), (None, 1)}
    pruned = sinks.read_fact(spark, path, "2024-02", "2024-02")
    assert [tuple(r)[:2] for r in pruned.select("comment_id", "content").collect()] == [(1, "new")]
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "2024-02" in plan


def test_rfm_outputs_begin_with_a_byte_order_mark(spark, tmp_dir):
    import glob
    from revlens.plans import catalog
    from tests.conftest import SF001
    outputs = catalog.rfm_outputs(spark, SF001)
    sinks.write_rfm_outputs(outputs, tmp_dir)
    sinks.write_rfm_outputs(outputs, tmp_dir)   # a second run replaces the first
    for name in sinks.RFM_OUTPUTS:
        files = glob.glob(f"{tmp_dir}/{name}.csv/part-*") if name == sinks.RFM_OUTPUTS[0] else [f"{tmp_dir}/{name}.csv"]
        lines = 0
        for file in files:
            data = open(file, "rb").read()
            assert data.startswith(b"\xef\xbb\xbf" + ",".join(outputs[name].columns).encode() + b"\n")
            lines += data.decode("utf-8-sig").count("\n") - 1
        assert files and lines == outputs[name].count()


def test_dropped_rows_are_counted_while_the_rows_are_written(spark, tmp_dir):
    from revlens.operators import clean
    rows = [(1, 5.0), (2, None), (None, 4.0), (4, 1.0), (5, 4.0)]
    df = spark.createDataFrame(rows, "customer_id long, rating double")
    report = clean.DroppedRows()
    out = report.step("nulls", df, lambda d: clean.drop_required_nulls(d, ["customer_id", "rating"]))
    out = report.step("rating", out, clean.rating_filter)
    out.write.parquet(f"{tmp_dir}/kept")
    assert [tuple(r) for r in report.report(spark).orderBy("step_no").collect()] == [(0, "nulls", 5, 3, 2), (1, "rating", 3, 2, 1)]
    assert spark.read.parquet(f"{tmp_dir}/kept").count() == 2

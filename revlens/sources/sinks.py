"""Sinks (S7–S13).

Large tables are written as Parquet in parallel.  ``coalesce(1)`` single-file
CSV is offered only for small summaries (it serialises the last stage).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.functions.fmt import fixed


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Header CSV with every field quoted, overwrite."""
    out = df.coalesce(1) if single_file else df
    (out.write.mode("overwrite")
        .option("header", True).option("quote", '"').option("escape", '"')
        .option("quoteAll", True).csv(path))


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet sink; ``partition_by`` (e.g. a month column) enables pruning."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_named_outputs(outputs: dict[str, DataFrame], base: str,
                        fmt: str = "parquet", partition_by: dict | None = None) -> None:
    """Write several named results under one base path."""
    for name, df in outputs.items():
        path = f"{base.rstrip('/')}/{name}"
        if fmt == "csv":
            write_csv(df, path)
        else:
            write_table(df, path, (partition_by or {}).get(name))


MONTH = "month"


def write_fact(fact: DataFrame, path: str, ts: str = "purchased_at_ts", key: str = "comment_id") -> None:
    """The merged fact as Parquet, one partition per ``yyyy-MM`` of ``ts``.

    Only the months present in ``fact`` are replaced (dynamic partition overwrite); others
    stay.  Rows are ranged by (month, key): a month lands in few files, and a month with
    most rows spreads over several tasks.  Rows without a time go to Spark's null partition."""
    rows = fact.withColumn(MONTH, F.date_format(ts, "yyyy-MM"))
    (rows.repartitionByRange(MONTH, key).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path))


def read_fact(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The fact, of the months ``first`` to ``last`` only when given (partition pruning).
    The month stays text."""
    rows = spark.read.option("basePath", path).parquet(path)
    rows = rows.withColumn(MONTH, F.col(MONTH).cast("string")) if dict(rows.dtypes)[MONTH] != "string" else rows
    if first is not None:
        rows = rows.filter(F.col(MONTH) >= first)
    return rows if last is None else rows.filter(F.col(MONTH) <= last)


BOM = "\ufeff"
#: The names of the RFM job's five output tables; the first has a row per customer.
RFM_OUTPUTS = ["danh_sach_khach_hang", "tong_hop_phan_khuc", "xu_huong_theo_thang", "xu_huong_theo_tuan", "top_seller"]


def write_bom_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV that spreadsheet programs read as UTF-8: every file begins with a byte-order mark.

    The mark is the first character of the header, which Spark's writer puts at the
    start of each file, so files are written in parallel and nothing is rewritten.  With
    ``single_file`` (small tables) ``path`` is one file: the only part is renamed on the
    target file system; else a folder of parts."""
    spark = df.sparkSession
    marked = df.withColumnRenamed(df.columns[0], BOM + df.columns[0])
    folder = f"{path}.parts" if single_file else path
    (marked.coalesce(1) if single_file else marked).write.mode("overwrite").option("header", True) \
        .option("escape", '"').option("encoding", "UTF-8").csv(folder)
    if single_file:
        hadoop = spark._jvm.org.apache.hadoop.fs
        source, target = hadoop.Path(folder), hadoop.Path(path)
        fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
        part = next(s.getPath() for s in fs.listStatus(source) if s.getPath().getName().startswith("part-"))
        if fs.exists(target):
            fs.delete(target, True)
        fs.rename(part, target)
        fs.delete(source, True)


def write_rfm_outputs(outputs: dict[str, DataFrame], base: str) -> None:
    """The five tables of the RFM job as CSV with a byte-order mark under ``base``; the
    customer list as a folder of parts, the small ones as one file each."""
    for name in RFM_OUTPUTS:
        write_bom_csv(outputs[name], f"{base.rstrip('/')}/{name}.csv", single_file=name != RFM_OUTPUTS[0])


def export_recommendations(recs: DataFrame, products: DataFrame) -> DataFrame:
    """Ranked long table with product names; unknown ids named 'Unknown'.

    ``recs``: (customer_id, rank, product_id); ``products``: (product_id,
    product_name).  The product dimension is joined by key (Spark broadcasts
    it when its measured size is under the broadcast threshold).
    """
    names = products.select("product_id", "product_name")
    return (recs.join(names, "product_id", "left")
            .select(F.col("customer_id").alias("Customer_ID"), F.col("rank").alias("Rank"),
                    F.col("product_id").alias("Product_ID"),
                    F.coalesce("product_name", F.lit("Unknown")).alias("Product_Name")))


def _side_text(c: str) -> F.Column:
    return F.array_join(F.array_sort(F.col(c)), ", ")


def export_rules(rules: DataFrame) -> DataFrame:
    """Sorted, comma-joined sides and 4-decimal measures as text."""
    return rules.select(
        _side_text("antecedent").alias("Antecedent_Products"),
        _side_text("consequent").alias("Consequent_Products"),
        fixed("support").alias("Support"), fixed("confidence").alias("Confidence"),
        fixed("lift").alias("Lift"))


def _named_side(rules: DataFrame, side: str, names: DataFrame) -> DataFrame:
    ex = rules.select("rule_id", F.posexplode(side).alias("pos", "item"))
    named = (ex.join(names, ex.item == names.product_id, "left")
             .select("rule_id", "pos", "item",
                     F.coalesce(F.col("product_name"),
                                F.concat(F.lit("Unknown_ID_"), F.col("item").cast("string"))).alias("nm")))
    return (named.groupBy("rule_id")
            .agg(F.array_sort(F.collect_list(F.struct("pos", "item", "nm"))).alias("s"))
            .select("rule_id",
                    F.array_join(F.transform("s", lambda x: x["item"].cast("string")), ", ").alias(f"{side}_ids"),
                    F.array_join(F.transform("s", lambda x: x["nm"]), ", ").alias(f"{side}_names")))


def export_rules_named(rules: DataFrame, products: DataFrame, top_n: int = 1000) -> DataFrame:
    """Numbered top rules (by lift) with product names on both sides.

    Rule sides are short arrays, so the per-rule regrouping is bounded.
    """
    names = products.select(F.col("product_id"), F.col("product_name"))
    w = Window.orderBy(F.desc("lift"), F.desc("confidence"),
                       F.col("antecedent").cast("string"), F.col("consequent").cast("string"))
    top = (rules.orderBy(F.desc("lift"), F.desc("confidence"),
                         F.col("antecedent").cast("string"), F.col("consequent").cast("string"))
           .limit(top_n)
           .withColumn("rule_id", F.row_number().over(w)))
    a = _named_side(top, "antecedent", names)
    c = _named_side(top, "consequent", names)
    return (top.join(a, "rule_id").join(c, "rule_id")
            .select(F.col("rule_id").alias("Rule_ID"),
                    F.col("antecedent_ids").alias("Antecedent_Products"),
                    F.col("antecedent_names").alias("Antecedent_Product_Name"),
                    F.col("consequent_ids").alias("Consequent_Products"),
                    F.col("consequent_names").alias("Consequent_Product_Name"),
                    fixed("support").alias("Support"), fixed("confidence").alias("Confidence"),
                    fixed("lift").alias("Lift")))


def save_rule_model(model, itemsets: DataFrame, rules: DataFrame, path: str, params: dict) -> None:
    """Persist the fitted FP-Growth model, itemsets, rules and thresholds."""
    base = path.rstrip("/")
    model.write().overwrite().save(f"{base}/model")
    itemsets.write.mode("overwrite").parquet(f"{base}/itemsets")
    rules.write.mode("overwrite").parquet(f"{base}/rules")
    spark = itemsets.sparkSession
    spark.createDataFrame([(k, float(v)) for k, v in sorted(params.items())], "name string, value double") \
        .write.mode("overwrite").parquet(f"{base}/params")


def load_rule_model(spark, path: str):
    """Load what ``save_rule_model`` wrote -> (model, itemsets, rules, params)."""
    from pyspark.ml.fpm import FPGrowthModel
    base = path.rstrip("/")
    params = {r["name"]: r["value"] for r in spark.read.parquet(f"{base}/params").collect()}
    return (FPGrowthModel.load(f"{base}/model"), spark.read.parquet(f"{base}/itemsets"),
            spark.read.parquet(f"{base}/rules"), params)
